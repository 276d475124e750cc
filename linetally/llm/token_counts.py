"""Exact token counts of texts, looked up chunk by chunk.

Two tiers, both on the map side.  A first pass over all texts lets every task count its chunks
in bounded memory; the most frequent ones overall (at most ``table_size``) are encoded once and
broadcast as a compact table chunk -> number of tokens.  In the second pass each worker sums
table entries and encodes what the table lacks, through a bounded cache of its own.  Chunks
themselves are never shuffled, only each task's few heaviest with their counts.

Which chunks are in the table changes speed, never counts.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows and ids are counted
each by itself; texts of any length and with any white space are counted whole, by their chunks; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.llm.pieces import SPACE, check_cuts, read_model, spaced_chunks
from linetally.llm.pretokens import Chunks, Memo, chunks_of, holds, plain_texts, text_slices
from linetally.llm.store import stored
from linetally.llm.workers import shipped

TABLE_SIZE = 65_536
HEAVY_PER_TASK = 20_000
COUNTER_SIZE = 500_000
STEPS_PER_DOUBLING = 8
TABLE_CHUNK = 128  # bytes of the longest chunks in the table, which thus has 8 MB of them at most


@lru_cache(maxsize=4)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _chunks(texts: pa.Array) -> Chunks:
    """Chunks whose token counts add up to the text's.

    The library puts a space before the text, so the first word starts like any other.  Pieces do not
    reach across the start of a run of spaces or a line end, where all texts are cut.
    """
    plain = plain_texts(texts) & ~holds(texts, SPACE)
    return chunks_of(pc.binary_join_element_wise(" ", texts, ""), plain, spaced_chunks)


def chunk_lengths(path: str, chunks: list[bytes]) -> list[int]:
    """Tokens of each chunk inside a text; the empty one before the first space has none.

    A word brings its first space, which the library adds by itself.  Any other chunk is encoded
    after a line end, whose two tokens (the added space, the byte) are taken off again.
    """
    texts = [chunk.decode() for chunk in chunks]
    worded = [not x or (x[0] == " " and bool(x.strip(" " + SPACE))) for x in texts]
    encoded = _processor(path).encode([x[1:] if w else "\n" + x for x, w in zip(texts, worded, strict=True)], num_threads=1)
    return [len(ids) - (0 if w else 2) for w, ids in zip(worded, encoded, strict=True)]


def heavy_chunks(docs: DataFrame, size: int = TABLE_SIZE) -> list[bytes]:
    """The most frequent chunks of all texts, at most ``size``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for _, texts in text_slices(batch):
                chunks = _chunks(texts)
                counts = np.bincount(chunks.index, minlength=len(chunks.distinct)).tolist()
                seen.update({x: n for x, n in zip(chunks.distinct, counts, strict=True) if len(x) <= TABLE_CHUNK})
                if len(seen) > COUNTER_SIZE:
                    seen = Counter(dict(seen.most_common(COUNTER_SIZE // 4)))
        top = seen.most_common(HEAVY_PER_TASK)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array([x for x, _ in top], pa.binary()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    sums = (
        shipped(docs)
        .select(F.col("text").cast("string"))
        .mapInArrow(count, "chunk binary, n long")
        .groupBy("chunk")
        .agg(F.sum("n").alias("n"))
    )
    sums = stored(sums.withColumn("step", F.floor(F.log2("n") * STEPS_PER_DOUBLING).cast("int")), "heavy-chunks")
    # A few hundred steps of frequency at most; the table takes as many whole ones as fit.
    taken, least = 0, None
    for row in sorted(sums.groupBy("step").count().collect(), reverse=True):
        taken += row["count"]
        if taken > size:
            break
        least = row["step"]
    if least is None:
        return []
    return [bytes(row.chunk) for row in sums.where(F.col("step") >= least).select("chunk").collect()]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, table_size: int = TABLE_SIZE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document, by the sentencepiece model at a path."""
    check_cuts(piece.piece for piece in read_model(model).pieces)
    heavy = heavy_chunks(docs, table_size)
    lengths = dict(zip(heavy, chunk_lengths(model, heavy), strict=True)) if heavy else {}
    table = docs.sparkSession.sparkContext.broadcast(lengths)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(lambda new: chunk_lengths(model, new), fixed=table.value)
        for batch in batches:
            for rows, texts in text_slices(batch):
                chunks = _chunks(texts)
                n_tokens = chunks.sum(memo.values_of(chunks.distinct))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id"),
                        "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                        "n_tokens": pa.array(n_tokens, pa.int64()),
                        "over_limit": pa.array(n_tokens > limit),
                    }
                )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return shipped(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, schema)
