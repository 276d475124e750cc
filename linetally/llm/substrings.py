"""Removing passages that an earlier document has, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words of a document.  A word goes if some window over it has
the word sequence of a window of a document with a smaller doc_id; windows are judged on the
input.

Anchors.  Only windows of ``ANCHOR`` words at positions whose remainder modulo ``PERIOD`` lies in
``COVER`` are hashed.  COVER is a difference cover: for any two remainders some shift below
PERIOD takes both into it.  As ANCHOR + PERIOD - 1 = WINDOW, two equal windows, wherever they
start, share an anchor at the same place inside them.  So only words around anchors that occur
in several documents can be part of a match; there every window is extended to its full length
and compared by 96 bits of hash.

Documents are dealt by doc_id and text into groups of a bounded number and of bounded bytes on average,
whatever share of them has one doc_id or none; only repeats of a whole row always meet in one group.  What a group has several times is settled
inside the group, and between groups only one entry per group and distinct anchor or window
travels, so a passage that a third of all documents share costs one entry per group.

Defined cases: a null or empty text has no words.  Windows of documents with equal doc_id do not
remove each other.  A null doc_id counts as larger than all others.  Texts of any length are cut
whole; a group holds one at least.  An empty table gives an empty result.  Other columns are ignored by
``removals`` and kept by ``cut_repeats``, whatever their names and types.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linetally.llm.names import quoted
from linetally.llm.workers import shipped

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
DOCS_PER_GROUP = 1_000
BYTES_PER_GROUP = 32_000_000
GROUPS_PER_BUCKET = 4
LAST = np.iinfo(np.int64).max
# Odd multipliers of the two rolling hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass
class GroupWords:
    """The words of a group of documents, one after the other."""

    doc_ids: np.ndarray
    words: list[list[bytes]]
    hashes: np.ndarray = field(init=False)
    doc_of: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)
    left: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        counts = np.array([len(w) for w in self.words], np.int64)
        digest = xxhash.xxh64_intdigest
        self.hashes = np.array([h for w in self.words for h in map(digest, w)], np.uint64)
        self.doc_of = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(self.hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.left = np.repeat(counts, counts) - self.place  # words from here to the end of the document

    def window_hashes(self, width: int, factor: int) -> np.ndarray:
        """A hash of the ``width`` words from each place where they end within the group."""
        n = max(0, len(self.hashes) - width + 1)
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total = total * np.uint64(factor) + self.hashes[i : i + n]
        return total

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the anchors in the group, and their hashes."""
        covered = np.isin(self.place % PERIOD, COVER) & (self.left >= ANCHOR)
        at = np.flatnonzero(covered)
        return at, self.window_hashes(ANCHOR, FACTORS[0])[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all full windows, and their hashes: 64 bits and 32 more, as two columns."""
        at = np.flatnonzero(self.left >= WINDOW)
        first, second = (self.window_hashes(WINDOW, factor)[at] for factor in FACTORS)
        return at, np.stack([first, second >> np.uint64(32)], axis=1)


def group_words(rows: pa.Table) -> GroupWords:
    doc_ids = rows.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy()
    return GroupWords(doc_ids, [(t or "").encode().split() for t in rows.column("text").to_pylist()])


def _in_several(docs: np.ndarray, hashes: np.ndarray, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, and for each whether documents of different id have it."""
    values, inverse = np.unique(hashes, return_inverse=True)
    ids = doc_ids[docs]
    low, high = np.full(len(values), LAST), np.full(len(values), np.iinfo(np.int64).min)
    np.minimum.at(low, inverse, ids)
    np.maximum.at(high, inverse, ids)
    return values, low != high


def _rows(buckets: np.ndarray, columns: dict[str, np.ndarray]) -> dict[str, list]:
    """Columns cut into one list per bucket."""
    order = np.argsort(buckets, kind="stable")
    edges = np.flatnonzero(np.diff(buckets[order])) + 1
    cut = {name: np.split(values[order], edges) if len(order) else [] for name, values in columns.items()}
    return {"bucket": buckets[order][[0, *edges]] if len(order) else [], **cut}


def _table(columns: dict, schema: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array(list(columns[name]), kind) for name, kind in schema.items()})


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64)


def group_anchors(n_buckets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def emit(key: tuple, rows: pa.Table) -> pa.Table:
        words = group_words(rows)
        at, hashes = words.anchors()
        values, several = _in_several(words.doc_of[at], hashes, words.doc_ids)
        buckets = (values % np.uint64(n_buckets)).astype(np.int64)
        cut = _rows(buckets, {"hashes": _signed(values), "several": several})
        cut["g"] = [key[0].as_py()] * len(cut["bucket"])
        return _table(
            cut, {"bucket": pa.int64(), "g": pa.int64(), "hashes": _LONGS, "several": pa.list_(pa.bool_())}
        )

    return emit


def _flat(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _owner(rows: pa.Table, name: str) -> np.ndarray:
    """The group of each entry of a list column."""
    lengths = rows.column(name).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(rows.column("g").to_numpy(), lengths)


def _by_group(groups: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    cut = _rows(groups, columns)
    cut["g"] = cut.pop("bucket")
    kinds = {name: _INTS if values.dtype == np.int32 else _LONGS for name, values in columns.items()}
    return _table(cut, {"g": pa.int64(), **kinds})


def shared_anchors(key: tuple, rows: pa.Table) -> pa.Table:
    """For each group the anchors that only one of its documents, but another group has."""
    hashes, several, groups = _flat(rows, "hashes"), _flat(rows, "several"), _owner(rows, "hashes")
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    tell = (counts[inverse] > 1) & ~several
    return _by_group(groups[tell], {"hashes": hashes[tell]})


def _near_anchors(words: GroupWords, shared: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which windows hold an anchor that occurs in several documents."""
    at, hashes = words.anchors()
    values, several = _in_several(words.doc_of[at], hashes, words.doc_ids)
    hot = np.isin(hashes, values[several]) | np.isin(hashes, shared)
    marks = np.zeros(len(words.hashes) + 1, np.int64)
    marks[at[hot] + 1] = 1
    before = np.cumsum(marks)
    return before[starts + PERIOD] > before[starts]  # an anchor starts at one of the first PERIOD words


def _least_ids(words: GroupWords, starts: np.ndarray, hashes: np.ndarray) -> tuple:
    """Distinct windows as (hashes, least doc_id in the group, place of each window among them)."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    ranked = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    least = np.full(int(new.sum()), LAST)
    np.minimum.at(least, inverse, words.doc_ids[words.doc_of[starts]])
    return ranked[new], least, inverse


def group_windows(n_buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def emit(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        words = group_words(rows)
        starts, hashes = words.windows()
        near = _near_anchors(words, _flat(told, "hashes").astype(np.uint64), starts)
        values, least, _ = _least_ids(words, starts[near], hashes[near])
        buckets = (values[:, 0] % np.uint64(n_buckets)).astype(np.int64)
        second = values[:, 1].astype(np.uint32).view(np.int32)
        cut = _rows(buckets, {"h1": _signed(values[:, 0]), "h2": second, "least": least})
        cut["g"] = [key[0].as_py()] * len(cut["bucket"])
        return _table(cut, {"bucket": pa.int64(), "g": pa.int64(), "h1": _LONGS, "h2": _INTS, "least": _LONGS})

    return emit


def first_windows(key: tuple, rows: pa.Table) -> pa.Table:
    """For each group the windows that a smaller doc_id of another group has, with that doc_id."""
    h1, h2, least, groups = (*(_flat(rows, x) for x in ("h1", "h2", "least")), _owner(rows, "h1"))
    order = np.lexsort((h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    first = np.full(int(new.sum()), LAST)
    np.minimum.at(first, inverse, least)
    tell = first[inverse] < least
    return _by_group(groups[tell], {"h1": h1[tell], "h2": h2[tell], "first": first[inverse][tell]})


def removed_words(rows: pa.Table, told: pa.Table) -> tuple[GroupWords, np.ndarray]:
    """The words of a group, and which of them an earlier document has."""
    words = group_words(rows)
    starts, hashes = words.windows()
    values, least, inverse = _least_ids(words, starts, hashes)
    told_pairs = np.stack([_flat(told, "h1").astype(np.uint64), _flat(told, "h2").astype(np.uint32)], axis=1)
    if len(told_pairs):
        pair = np.dtype([("a", "<u8"), ("b", "<u8")])
        known = np.ascontiguousarray(values).view(pair).ravel()
        asked = np.ascontiguousarray(told_pairs).view(pair).ravel()
        place = np.searchsorted(known, asked)  # known are in order, and hold all that was told
        np.minimum.at(least, place, _flat(told, "first"))
    late = starts[least[inverse] < words.doc_ids[words.doc_of[starts]]]
    change = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(change, late, 1)
    np.add.at(change, late + WINDOW, -1)
    return words, np.cumsum(change[:-1]) > 0


def _per_document(words: GroupWords, gone: np.ndarray) -> Iterator[np.ndarray]:
    ends = np.cumsum([len(w) for w in words.words])
    return (gone[end - len(w) : end] for w, end in zip(words.words, ends, strict=True))


def digest_rows(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
    words, gone = removed_words(rows, told)
    n_removed, digests = [], []
    for own, out in zip(words.words, _per_document(words, gone), strict=True):
        n_removed.append(int(out.sum()))
        kept = [w for w, o in zip(own, out.tolist(), strict=True) if not o] if n_removed[-1] else own
        digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return pa.table(
        {
            "doc_id": rows.column("doc_id"),
            "n_words": pa.array([len(w) for w in words.words], pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


def without_words(text: str, out: np.ndarray) -> str:
    """The text without the marked words; what follows a removed word up to the next one goes too."""
    pieces, at = [], 0
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    for i, gone in enumerate(out.tolist()):
        start = spans[i][0]
        end = spans[i + 1][0] if i + 1 < len(spans) else len(text)
        if i == 0:
            pieces.append(text[:start])
        at = end
        if not gone:
            pieces.append(text[start:end])
    return "".join(pieces) if spans else text


def cut_rows(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
    words, gone = removed_words(rows, told)
    texts = [
        without_words(text, out) if out.any() else text
        for text, out in zip(rows.column("text").to_pylist(), _per_document(words, gone), strict=True)
    ]
    place = rows.schema.get_field_index("text")
    return rows.set_column(place, "text", pa.array(texts, pa.string())).drop_columns([rows.column_names[-1]])


def _removal_pass(
    docs: DataFrame, last: Callable[[tuple, pa.Table, pa.Table], pa.Table], schema: str | StructType, docs_per_group: int
) -> DataFrame:
    """Three visits to the groups: anchors, windows around shared anchors, removal.

    All three read one and the same exchange of the texts.
    """
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_groups = max(1, -(-size.n // docs_per_group), -(-(size.bytes or 0) // BYTES_PER_GROUP))
    n_buckets = max(1, -(-n_groups // GROUPS_PER_BUCKET))
    group = "g" + "_" * max(map(len, docs.columns))  # no column of docs is called that
    grouped = shipped(docs).withColumn(group, F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups))).groupBy(group)
    anchors = grouped.applyInArrow(
        group_anchors(n_buckets), "bucket long, g long, hashes array<long>, several array<boolean>"
    )
    shared = anchors.groupBy("bucket").applyInArrow(shared_anchors, "g long, hashes array<long>")
    windows = grouped.cogroup(shared.groupBy("g")).applyInArrow(
        group_windows(n_buckets), "bucket long, g long, h1 array<long>, h2 array<int>, least array<long>"
    )
    first = windows.groupBy("bucket").applyInArrow(
        first_windows, "g long, h1 array<long>, h2 array<int>, first array<long>"
    )
    return grouped.cogroup(first.groupBy("g")).applyInArrow(last, schema)


def removals(docs: DataFrame, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (kept words joined by a space) per document."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _removal_pass(texts, digest_rows, schema, docs_per_group)


def cut_repeats(docs: DataFrame, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """docs with the removed words cut out of ``text``; the spacing of the rest stays."""
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    rest = F.struct(*[quoted(name) for name in others]) if others else F.struct(F.lit(0).alias("none"))
    packed = docs.select("doc_id", "text", rest.alias("rest"))
    cut = _removal_pass(packed, cut_rows, packed.schema, docs_per_group)
    own = {name: F.col("rest")[name].alias(name) for name in others}
    return cut.select([own[name] if name in own else F.col(name) for name in docs.columns])
