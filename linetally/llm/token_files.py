"""Token ids of all documents as files of raw ids, with keyed access.

The file format: a Parquet folder with one row per block of at most about ``BLOCK_IDS`` ids.  Lists of
numbers are little-endian bytes, read where they lie.

    shard, block    documents ascend by doc_id within a block, from block to block and shard to shard
    before, n_ids   ids in earlier blocks of the shard, and in the block
    nulls           documents without doc_id, which lie in front
    low, high       first and last doc_id
    levels, bits, ranks, prints    minimal perfect hash of the doc_ids -> slot, with fingerprints
    slot_first, slot_docs   first document of a slot, number of documents with that doc_id
    offsets         where each document's ids start, and the end of the last
    width           bytes per id (2 where the vocabulary fits, else 4)
    payload         the ids
    doc_ids         the doc_ids in order, for readers of whole files; access by key does not open this column

A doc_id leads to its ids in constant time: the shard and block by their ranges, the slot by the hash, the
place by the slot.  Blocks are written by Spark tasks, each from one range of doc_ids, so a lost
executor only repeats its ranges.

Defined cases: a null or empty text has just the end id.  Documents with equal doc_id lie
together, ordered by text, and share a slot; where very many have one, they take several blocks and shards, cut
by the beginnings of their texts.  Null doc_ids come before all others.  Texts of any length are encoded
whole and lie in one block.  An empty table gives no blocks.  Other columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linetally.llm.mph import PerfectHash
from linetally.llm.pretokens import Memo, chunks_of, cut, plain_texts, stops_follow_words, text_slices
from linetally.llm.store import stored
from linetally.llm.workers import shipped

BLOCK_IDS = 1 << 20
BYTES_AT_ONCE = 20_000
CHARS_AT_ONCE = 10_000_000
CACHE_BYTES = 160_000_000
BLOCK_SCHEMA = (
    "shard int, block int, before long, n_ids long, nulls int, low long, high long, levels binary, bits binary, "
    "ranks binary, prints binary, slot_first binary, slot_docs binary, offsets binary, width int, payload binary, "
    "doc_ids binary"
)
# How the lists of numbers in a block are written; fixed values of the format.
KINDS = {
    "levels": "<i8",
    "bits": "<u8",
    "ranks": "<u4",
    "prints": "<u4",
    "slot_first": "<i4",
    "slot_docs": "<i4",
    "offsets": "<i8",
    "doc_ids": "<i8",
}
INDEX = ["shard", "block", "before", "nulls", "levels", "bits", "ranks", "prints", "slot_first", "slot_docs", "offsets", "width", "payload"]
START_CHARS = 32


# Lines whose white space at an end would go with the line end; one space before a word does not.
_MERGING = re.compile(r"\s\n|\n(?! ?\S)")


def byte_level_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte.

    Visible characters of Latin-1 are themselves; the other bytes, in order, are U+0100 and after.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in visible]
    return {**{byte: chr(byte) for byte in visible}, **{byte: chr(256 + n) for n, byte in enumerate(others)}}


class LibraryEncoder:
    """Encodes texts by a tokenizer file; chunks that recur are encoded once.

    Texts are cut only for byte-level tokenizers with the usual pattern and nothing before or
    after it.  For others, and where a text spells an added token, the library gets whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        plan = json.loads(self._tokenizer.to_str())
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self._cuts = usual.items() <= (plan["pre_tokenizer"] or {}).items() and not (
            plan["normalizer"] or plan["post_processor"] or plan["truncation"] or plan["padding"]
        )
        # Merges of words may be asked for by themselves where nothing else is done to them.
        self._cuts &= plan["model"]["type"] == "BPE"
        self._letters = byte_level_letters()
        self._line_end = self._ids(["\n"])[0].tolist()
        self._memo = Memo(self._encode_chunks, capacity_bytes=CACHE_BYTES)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, f"<u{self.width}") for x in found]

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of new chunks.

        A word of letters is one match of the pattern and goes straight to the library's merges;
        of others many are encoded together, but no more than some bytes.
        """
        if not self._cuts:
            return [ids.tobytes() for ids in self._ids([chunk.decode() for chunk in chunks])]
        merges, kind, letters = self._tokenizer.model.tokenize, f"<u{self.width}", self._letters
        found: list[bytes | None] = [None] * len(chunks)
        for k, chunk in enumerate(chunks):
            if chunk.decode().removeprefix(" ").isalpha():
                tokens = merges(chunk.decode("latin-1").translate(letters))
                found[k] = np.array([token.id for token in tokens], kind).tobytes()
        rest = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(rest, self._encode_groups([chunks[k] for k in rest]), strict=True):
            found[k] = ids
        return found

    def _encode_groups(self, chunks: list[bytes]) -> list[bytes]:
        if len(self._line_end) != 1:
            return [ids.tobytes() for ids in self._ids([chunk.decode() for chunk in chunks])]
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        found, start = [], 0
        while start < len(chunks):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, "right")))
            found += self._encode_lines(chunks[start:end])
            start = end
        return found

    def _encode_lines(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks, encoded as the lines of one text if that leaves them as they are."""
        text = b"\n".join(chunks).decode()
        if text.count("\n") != len(chunks) - 1 or _MERGING.search(f"\n{text}\n."):
            return [ids.tobytes() for ids in self._ids([chunk.decode() for chunk in chunks])]
        ids = self._ids([text])[0]
        raw, ends = ids.tobytes(), (np.flatnonzero(ids == self._line_end[0]) * self.width).tolist()
        starts = [0, *[end + self.width for end in ends]]
        return list(map(raw.__getitem__, map(slice, starts, [*ends, len(raw)])))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, ``width`` bytes each."""
        whole = np.full(len(texts), not self._cuts)
        for added in self._added:
            whole |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False).astype(bool)
        spelled = set(texts.filter(pa.array(whole)).to_pylist())
        plain = plain_texts(texts) & stops_follow_words(texts) & ~whole
        chunks = chunks_of(texts, plain, lambda text: [] if text in spelled else cut(text), stops=True)
        found = chunks.join(self._memo.values_of(chunks.distinct), self.width)
        places = np.flatnonzero(whole).tolist()
        for i, ids in zip(places, self._ids([texts[i].as_py() for i in places]), strict=True):
            found[i] = ids.tobytes()
        return found


@lru_cache(maxsize=2)
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def block_row(shard: int, block: int, before: int, doc_ids: list, ids: list[bytes], width: int) -> dict:
    """The row of one block."""
    lengths = np.array([len(x) // width for x in ids], np.int64)
    named = np.array([x for x in doc_ids if x is not None], np.int64)
    nulls = len(doc_ids) - len(named)
    keys, first, counts = np.unique(named, return_index=True, return_counts=True)
    index = PerfectHash.build(keys)
    slots = index.find(keys)
    slot_first, slot_docs = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    slot_first[slots], slot_docs[slots] = first + nulls, counts
    lists = {
        "levels": index.sizes,
        "bits": index.words,
        "ranks": index.ranks,
        "prints": index.prints,
        "slot_first": slot_first,
        "slot_docs": slot_docs,
        "offsets": np.concatenate([[0], np.cumsum(lengths)]),
        "doc_ids": named,
    }
    return {
        "shard": shard,
        "block": block,
        "before": before,
        "n_ids": int(lengths.sum()),
        "nulls": nulls,
        "low": int(keys[0]) if len(keys) else None,
        "high": int(keys[-1]) if len(keys) else None,
        **{name: numbers.astype(KINDS[name]).tobytes() for name, numbers in lists.items()},
        "width": width,
        "payload": b"".join(ids),
    }


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode all texts, each followed by the end id, and write them in order of doc_id."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(BLOCK_SCHEMA))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        shard, block, before, doc_ids, ids, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [block_row(shard, block, before, doc_ids, ids, encoder.width)], schema=schema
            )

        for batch in batches:
            for rows, texts in text_slices(batch, CHARS_AT_ONCE):
                gc.disable()  # encoding makes no cycles; collections would only walk the caches
                try:
                    found = encoder.encode(texts)
                finally:
                    gc.enable()
                for name, got in zip(rows.column("doc_id").to_pylist(), found, strict=True):
                    doc_ids.append(name)
                    ids.append(got + end)
                    size += len(ids[-1]) // encoder.width
                    if size >= BLOCK_IDS:
                        yield flushed()
                        block, before, doc_ids, ids, size = block + 1, before + size, [], [], 0
        if ids:
            yield flushed()

    (
        shipped(docs)
        .select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        # Beginnings of texts go in their order, and are short enough for the sample of the ranges.
        .withColumn("start", F.substring("text", 1, START_CHARS))
        .repartitionByRange("doc_id", "start")
        .sortWithinPartitions("doc_id", "text")
        .drop("start")
        .mapInArrow(encode, BLOCK_SCHEMA)
        .write.parquet(path)
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return shipped(spark.read.schema(BLOCK_SCHEMA).parquet(path))


class Block:
    """One row of a batch of blocks, read where it lies."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, i: int):
        def numbers(name: str) -> np.ndarray:
            return np.frombuffer(rows.column(name)[i].as_buffer(), KINDS[name])

        self._index = PerfectHash(*map(numbers, ("levels", "bits", "ranks", "prints")))
        self._first, self._docs = numbers("slot_first"), numbers("slot_docs")
        self.offsets = numbers("offsets")
        self.nulls = rows.column("nulls")[i].as_py()
        self._width = rows.column("width")[i].as_py()
        self._payload = np.frombuffer(rows.column("payload")[i].as_buffer(), f"<u{self._width}")

    def documents(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all documents of these keys: the place of the key given, and of the document."""
        slots = self._index.find(keys)
        found = np.flatnonzero(slots >= 0)
        first, docs = self._first[slots[found]], self._docs[slots[found]]
        of_key = np.repeat(found, docs)
        skipped = np.repeat(np.cumsum(docs) - docs, docs)
        return of_key, np.repeat(first, docs) + np.arange(len(of_key)) - skipped

    def raw(self, first: int, last: int) -> bytes:
        """The ids from one offset to another as little-endian unsigned 32-bit integers."""
        return self._payload[first:last].astype("<u4").tobytes()

    def ids(self, place: int) -> list[int]:
        first, last = self.offsets[place : place + 2].tolist()
        return self._payload[first:last].tolist()


def shard_starts(blocks: DataFrame) -> DataFrame:
    """The ids before each shard: a running sum over one row per shard, read without payloads."""
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("shard_start"))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files by key."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                keys = np.unique(np.frombuffer(batch.column("doc_ids")[i].as_buffer(), KINDS["doc_ids"]))
                of_key, places = block.documents(keys)
                doc_ids = [None] * block.nulls + keys[of_key].tolist()
                places = np.concatenate([np.arange(block.nulls), places])
                starts, ends = block.offsets[places], block.offsets[places + 1]
                sums = [zlib.crc32(block.raw(a, b)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([batch.column("shard")[i].as_py()] * len(places), pa.int32()),
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "local": pa.array(batch.column("before")[i].as_py() + starts, pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    blocks = read_blocks(spark, path)
    digests = blocks.select(*INDEX, "doc_ids").mapInArrow(read, "shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    # One row per shard, and there are no more shards than shuffle partitions.
    return digests.join(F.broadcast(shard_starts(blocks)), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id and ids of the documents with the given keys (column doc_id); unknown keys give none.

    The range of each shard goes to every task, one row per task that wrote the files.  Within a shard keys meet
    the ranges of its blocks, and payloads only move for blocks that some key falls into.
    """
    blocks = read_blocks(spark, path).where("low is not null")
    shards = blocks.groupBy("shard").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = shards.orderBy("low", "high", "shard").toPandas()
    names, lows, highs = (ranges[c].to_numpy() for c in ("shard", "low", "high"))

    @F.pandas_udf("array<int>")
    def shards_of(doc_ids: pd.Series) -> pd.Series:
        first, last = np.searchsorted(highs, doc_ids), np.searchsorted(lows, doc_ids, "right")
        return pd.Series([names[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)])

    def blocks_of(wanted: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("low", "ascending"), ("high", "ascending")])
        doc_ids, low, high = (t.column(c).to_numpy() for t, c in ((wanted, "doc_id"), (rows, "low"), (rows, "high")))
        first = np.searchsorted(high, doc_ids)
        counts = np.maximum(np.searchsorted(low, doc_ids, "right") - first, 0)
        at = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        hit = rows.select(["shard", "block"]).take(pa.array(at))
        return hit.append_column("doc_id", pa.array(np.repeat(doc_ids, counts), pa.int64()))

    def fetch(key: tuple, wanted: pa.Table, rows: pa.Table) -> pa.Table:
        doc_ids, ids = [], []
        for i in range(rows.num_rows):
            block, asked = Block(rows, i), wanted.column("doc_id").to_numpy()
            of_key, places = block.documents(asked)
            doc_ids += asked[of_key].tolist()
            ids += [block.ids(x) for x in places]
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64()))})

    asked = (
        keys.select(F.col("doc_id").cast("long"))
        .where("doc_id is not null")
        .distinct()
        .withColumn("shard", F.explode(shards_of("doc_id")))
    )
    slim = blocks.select("shard", "block", "low", "high")
    wanted = stored(
        asked.groupBy("shard").cogroup(slim.groupBy("shard")).applyInArrow(blocks_of, "shard int, block int, doc_id long"),
        "asked-blocks",
    )
    hit = blocks.select(*INDEX).join(wanted.select("shard", "block").distinct(), ["shard", "block"], "left_semi")
    by = ["shard", "block"]
    return wanted.groupBy(*by).cogroup(hit.groupBy(*by)).applyInArrow(fetch, "doc_id long, ids array<long>")
