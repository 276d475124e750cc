"""The training corpus: documents through quality rules, near and substring dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, all but the last with
the columns of docs; ``run`` writes the result of each stage as Parquet to the shared folder and
reads it back for the next.  What a stage stored meanwhile, and its input, are deleted once its result
is written.

Defined cases, for all stages: columns beside those of documents stay, whatever their names and types
(the last stage returns digests only); texts are taken whole, whatever their length; an empty table gives
an empty one.  Each stage says what it does with nulls, empty texts and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.llm import byte_bpe, mixing, quality, queries, simhash, substrings
from linetally.llm.covering import Covering
from linetally.llm.store import fresh_path, passing
from linetally.sources import files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the fences of their language and source.

    Null and empty texts fail the base rule.  Null languages and sources are groups of their own.
    Repeated rows are judged alike, each by itself.
    """
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, whatever its doc_id.

    Null and empty texts have the fingerprint zero and are duplicates of each other.  Of repeated rows
    one stays.  Null doc_ids come after all others.
    """
    return simhash.one_of_each(docs, Covering(parts=3, distance=4), shingle=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has.

    Null texts stay null, and empty ones empty.  Documents with equal doc_id, repeated rows among
    them, do not cut each other; a null doc_id comes after all others.
    """
    return substrings.cut_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's weight asks for, in random order.

    Null and empty texts count nothing towards a source's size and are drawn like others.  Sources
    without a weight, and null, form one group.  Repeated rows are drawn each by itself.
    """
    return mixing.mix(docs, queries.SOURCE_WEIGHTS, rest_weight=queries.REST_WEIGHT)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids of every copy.

    Null and empty texts have no ids.  Repeated rows are encoded each by itself; a null doc_id stays null.
    """
    ranks = queries.tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_and_decode(docs, ranks, queries.split_pattern())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", encoding),
]

# Fingerprint bits and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        with passing(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        if before:
            files.remove(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), path
    return docs
