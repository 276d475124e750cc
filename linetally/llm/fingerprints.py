"""Document fingerprints that tell how versions differ: invertible Bloom lookup sketches.

A text is cut into paragraph pieces (sentences, at most ``PIECE_WORDS`` words long); the n-th
occurrence of a piece has a 64-bit digest of its own.  A sketch adds every digest to one cell in
each of ``HASHES`` rows of cells; a cell holds a count and xors of digests and of their checks.
Subtracting the sketches of two versions cancels what they share.  Peeling the rest, cells with
a single digest first, recovers the digests of the pieces that differ.  Where cells remain that
hold no single digest, the sketch was too small and the pair is tried again, ``GROWTH`` times
larger.  The fingerprint is the sketch of the first size.

Documents are read as streams, each of one range of their order, some megabytes of text at a time.
Only the first document of every range moves a second time, to the last of the range before.

Defined cases: a null text is empty, and empty texts are alike (1.0).  Documents with equal
doc_id follow each other by text, and are cut into ranges by its beginning; a null doc_id comes after all
others in descending order.  Repeated rows follow each other.  A single document is its own next one.  Texts of
any length are taken whole, with the next one, in the memory of a task.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linetally.llm.mph import mix
from linetally.llm.pretokens import text_slices
from linetally.llm.store import stored
from linetally.llm.workers import shipped

PIECE_WORDS = 8
PIECE = re.compile(rf"(?:[^\s.]+ ?){{1,{PIECE_WORDS}}}[.\s]*|[.\s]+")
HASHES = 3
FIRST_WIDTH = 4  # cells in a row of the fingerprint
GROWTH = 4
DOCS_AT_ONCE = 1_000
CHARS_AT_ONCE = 8_000_000
START_CHARS = 32
CELLS_AT_ONCE = 1 << 20
_U64 = np.uint64


def _check(digests: np.ndarray) -> np.ndarray:
    return mix(digests, HASHES) >> _U64(32)


@dataclass
class Digests:
    """Digests of the pieces of some texts: those of text i have ``owner`` i."""

    values: np.ndarray
    owner: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Digests:
        digest = xxhash.xxh64_intdigest
        found = [[digest(piece) for piece in PIECE.findall(text)] for text in texts]
        counts = np.array([len(x) for x in found], np.int64)
        plain = np.array([h for x in found for h in x], _U64)
        owner = np.repeat(np.arange(len(texts)), counts)
        order = np.lexsort((plain, owner))
        values, places = plain[order], np.arange(len(plain))
        new = np.ones(len(plain), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[order][1:] != owner[order][:-1])
        occurrence = places - np.maximum.accumulate(np.where(new, places, 0))
        return cls(mix(values + occurrence.astype(_U64) * _U64(0x632BE59BD9B4E019), HASHES + 1), owner[order], counts)

    def pick(self, texts: np.ndarray) -> Digests:
        """The digests of these texts, which become 0, 1, 2, ..."""
        ends = np.cumsum(self.counts)
        counts = self.counts[texts]
        shift = np.repeat(ends[texts] - np.cumsum(counts), counts)
        owner = np.repeat(np.arange(len(texts)), counts)
        return Digests(self.values[np.arange(len(owner)) + shift], owner, counts)


def _cells(digests: np.ndarray, owner: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The cell of each digest in every row; sketches lie one after the other."""
    for row in range(HASHES):
        place = (mix(digests, row) % _U64(width)).astype(np.int64)
        yield (owner * HASHES + row) * width + place


@dataclass
class Sketches:
    """Sketches of ``width`` cells in each row: counts, xored digests, xored checks."""

    width: int
    counts: np.ndarray
    digests: np.ndarray
    checks: np.ndarray

    @classmethod
    def of(cls, digests: Digests, width: int) -> Sketches:
        size = len(digests.counts) * HASHES * width
        made = cls(width, np.zeros(size, np.int64), np.zeros(size, _U64), np.zeros(size, _U64))
        made.add(digests.values, digests.owner, np.ones(len(digests.values), np.int64))
        return made

    def add(self, values: np.ndarray, owner: np.ndarray, signs: np.ndarray) -> None:
        checks = _check(values)
        for cells in _cells(values, owner, self.width):
            np.add.at(self.counts, cells, signs)
            np.bitwise_xor.at(self.digests, cells, values)
            np.bitwise_xor.at(self.checks, cells, checks)

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(
            self.width, self.counts - other.counts, self.digests ^ other.digests, self.checks ^ other.checks
        )

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sketch, digest, sign) of what is recovered, and which sketches are empty after it.

        Sign 1 means only on the left of the subtraction, -1 only on the right.
        """
        per_sketch = HASHES * self.width
        found: list[tuple] = []
        look = np.flatnonzero(np.abs(self.counts) == 1)
        for _ in range(per_sketch):
            single = look[(np.abs(self.counts[look]) == 1) & (_check(self.digests[look]) == self.checks[look])]
            owner, values, signs = single // per_sketch, self.digests[single], self.counts[single]
            order = np.lexsort((values, owner))
            new = np.ones(len(order), bool)
            new[1:] = (values[order][1:] != values[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            take = order[new]
            if not len(take):
                break
            owner, values, signs = owner[take], values[take], signs[take]
            found.append((owner, values, signs))
            self.add(values, owner, -signs)
            look = np.unique(np.concatenate(list(_cells(values, owner, self.width))))
        left = (self.counts != 0) | (self.digests != 0) | (self.checks != 0)
        clear = ~left.reshape(-1, per_sketch).any(axis=1)
        owner, values, signs = (
            np.concatenate(x) if found else np.zeros(0, kind)
            for x, kind in zip(zip(*found) if found else ((), (), ()), (np.int64, _U64, np.int64), strict=True)
        )
        return owner, values, signs, clear

    def strings(self) -> list[str]:
        """Each sketch as text: its counts, digests and checks, little-endian, in base 64."""
        shape = (-1, HASHES * self.width)
        columns = [
            self.counts.astype("<i4").reshape(shape).view(np.uint8),
            self.digests.astype("<u8").reshape(shape).view(np.uint8),
            self.checks.astype("<u4").reshape(shape).view(np.uint8),
        ]
        return [base64.b64encode(row.tobytes()).decode() for row in np.concatenate(columns, axis=1)]


def differences(digests: Digests, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of everything that differs between texts left[i] and right[i]."""
    open_, width, found = np.arange(len(left)), FIRST_WIDTH, []
    while len(open_):
        failed = []
        step = max(1, CELLS_AT_ONCE // (HASHES * width))
        for i in range(0, len(open_), step):
            some = open_[i : i + step]
            sketches = [Sketches.of(digests.pick(side[some]), width) for side in (left, right)]
            owner, values, signs, clear = sketches[0].minus(sketches[1]).peel()
            done = clear[owner]
            found.append((some[owner[done]], values[done], signs[done]))
            failed.append(some[~clear])
        open_, width = np.concatenate(failed), width * GROWTH
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, _U64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def likeness(digests: Digests, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared pieces as a share of all pieces of both, by what the sketches recover."""
    pair, _, signs = differences(digests, left, right)
    only_left = np.bincount(pair[signs > 0], minlength=len(left))
    only_right = np.bincount(pair[signs < 0], minlength=len(left))
    shared = digests.counts[left] - only_left
    every = shared + only_left + only_right
    return np.where(every == 0, 1.0, shared / np.maximum(every, 1))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _seams(schema: str) -> str:
    return f"{schema}, range_id int, seam string, seam_id long, seam_text string"


def with_next(
    docs: DataFrame, visit: Callable[[pa.Table, list[str]], pa.Table], schema: str, docs_at_once: int
) -> DataFrame:
    """visit(some documents in order, the text after each) for all documents by doc_id.

    The order is descending doc_id, and the first document follows the last.  What the visits give is
    stored, together with the first and last document of every range.
    """
    from pyspark import TaskContext

    names = [column.split()[0] for column in schema.split(", ")]

    def seam(kind: str, rows: pa.Table, i: int) -> pa.RecordBatch:
        fields = {"seam": kind, "seam_id": rows.column("doc_id")[i].as_py(), "seam_text": rows.column("text")[i].as_py()}
        empty = visit(rows.slice(0, 0), [])
        row = {name: pa.nulls(1, empty.column(name).type) for name in names}
        row["range_id"] = pa.array([TaskContext.get().partitionId()], pa.int32())
        kinds = {"seam": pa.string(), "seam_id": pa.int64(), "seam_text": pa.string()}
        return pa.RecordBatch.from_pydict({**row, **{n: pa.array([fields[n]], k) for n, k in kinds.items()}})

    def done(rows: pa.Table, following: list[str]) -> Iterator[pa.RecordBatch]:
        found, n = visit(rows, following), rows.num_rows
        found = found.append_column("range_id", pa.nulls(n, pa.int32()))
        for name, kind in (("seam", pa.string()), ("seam_id", pa.int64()), ("seam_text", pa.string())):
            found = found.append_column(name, pa.nulls(n, kind))
        yield from found.combine_chunks().to_batches()

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for rows, _ in text_slices(batch, CHARS_AT_ONCE):
                for start in range(0, rows.num_rows, docs_at_once):
                    some = pa.Table.from_batches([rows.slice(start, docs_at_once)])
                    if held is None:
                        yield seam("first", some, 0)
                    else:
                        some = pa.concat_tables([held, some])
                    n = some.num_rows - 1
                    if n:
                        yield from done(some.slice(0, n), some.column("text").to_pylist()[1:])
                    held = some.slice(n)
        if held is not None:
            yield seam("last", held, 0)

    def visit_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                yield from visit(row.select(["doc_id", "text"]), row.column("next_text").to_pylist()).to_batches()

    # Beginnings of texts go in their order, and are short enough for the sample of the ranges.
    order = F.col("doc_id").desc_nulls_last()
    ranges = (
        shipped(docs)
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .withColumn("start", F.substring("text", 1, START_CHARS))
        .repartitionByRange(order, "start")
        .sortWithinPartitions(order, "text")
        .drop("start")
    )
    found = stored(ranges.mapInArrow(follow, _seams(schema)), "with-next")
    firsts = found.where("seam = 'first'").select(F.col("range_id").alias("next_range"), F.col("seam_text").alias("next_text"))
    # One number per range; there are no more of them than shuffle partitions.
    around = Window.orderBy("range_id")
    every = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = found.where("seam = 'first'").select(
        "range_id", F.coalesce(F.lead("range_id").over(around), F.min("range_id").over(every)).alias("next_range")
    )
    lasts = (
        found.where("seam = 'last'")
        .select("range_id", F.col("seam_id").alias("doc_id"), F.col("seam_text").alias("text"))
        .join(after, "range_id")
        .join(firsts, "next_range")
        .select("doc_id", "text", "next_text")
    )
    return found.where("seam is null").select(*names).unionByName(lasts.mapInArrow(visit_one, schema))


def version_rows(rows: pa.Table, following: list[str]) -> pa.Table:
    """Fingerprints of the documents and of their edited versions, and how alike they are."""
    texts = rows.column("text").to_pylist()
    n = len(texts)
    changed = [edited(text, after) for text, after in zip(texts, following, strict=True)]
    digests = Digests.of([*texts, *changed, *following[-1:]])
    own = np.arange(n)
    after = np.append(own[1:], 2 * n) if n else own
    prints = Sketches.of(digests.pick(np.arange(2 * n)), FIRST_WIDTH).strings()
    return pa.table(
        {
            "doc_id": rows.column("doc_id"),
            "n_chars": pa.array([len(text) for text in texts], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed], pa.string()),
            "fingerprint": pa.array(prints[:n], pa.string()),
            "edited_fingerprint": pa.array(prints[n:], pa.string()),
            "near_edited": pa.array(likeness(digests, own, own + n)),
            "near_next": pa.array(likeness(digests, own, after)),
        }
    )


def version_fingerprints(docs: DataFrame, docs_at_once: int = DOCS_AT_ONCE) -> DataFrame:
    """One row per document, see ``version_rows``."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_next(docs, version_rows, schema, docs_at_once)
