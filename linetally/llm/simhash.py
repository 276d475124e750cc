"""SimHash fingerprints and their near-duplicate groups.

Fingerprints link where they differ in at most ``distance`` bits.  Equal fingerprints are merged
first; the distinct ones are replicated to the anchors of a covering code (see ``covering``) and
compared per anchor with those at home there.  An anchor with many fingerprints is compared in
cells of bounded size: visitors are dealt to cells, and those at home, the smaller side, go to all of them.  Each cell only passes on a spanning forest of the links it finds, so a
large group of near copies never becomes all its pairs.

Defined cases: a null or empty text, or one without words, has fingerprint 0 and links like any
other.  Repeated rows have equal fingerprints.  Null doc_ids take part, but a component is named
by its least doc_id that is not null.  An empty table gives an empty result.  Other columns are
ignored by ``simhash_components`` and kept by ``one_of_each``.  Only
``one_of_each`` goes by components where doc_ids are null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.components import components
from linetally.llm.covering import Covering
from linetally.llm.names import quoted
from linetally.llm.store import stored
from linetally.llm.workers import shipped

SHINGLE = 4
SEED = 42
HASHES_AT_ONCE = 1 << 18
CELL_ROWS = 8_192
HOME_ROWS = 131_072
PAIRS_AT_ONCE = 1 << 21


def _hashes(text: str, shingle: int) -> list[int]:
    """Hashes of the shingles of a text, repeats included; none if it has no words."""
    words = text.encode().lower().split()  # on bytes both touch ASCII only
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, lowest bit first."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        some = hashes[i : i + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Bit by bit, what over half of the shingles' hashes have set."""
    hashes = np.array(_hashes(text, shingle), np.uint64)
    majority = _set_bits(hashes) * 2 > len(hashes)
    return int.from_bytes(np.packbits(majority, bitorder="little").tobytes(), "little")


def _text_hashes() -> dict[str, Column]:
    """128 bits that stand for a text."""
    text = F.col("text").cast("string")
    return {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)}


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """doc_id and the fingerprint as a long (the same 64 bits, signed), with h1 and h2 if ``hashed``."""
    hashes = _text_hashes() if hashed else {}

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(text or "", shingle) for text in batch.column("text").to_pylist()]
            signed = np.array(prints, np.uint64).astype(np.int64)
            yield batch.drop_columns(["text"]).append_column("print", pa.array(signed))

    texts = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), *[h.alias(name) for name, h in hashes.items()]
    )
    schema = ", ".join(f"{name} long" for name in ("doc_id", *hashes, "print"))
    return shipped(texts).mapInArrow(compute, schema)


def _union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """labels, each the least place known to be connected, once a[i] and b[i] are too."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        apart = low != high
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        np.minimum.at(labels, high[apart], low[apart])
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def cell_links(home: np.ndarray, visitors: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between fingerprints at home and visitors."""
    nodes = np.unique(np.concatenate([home, visitors]))
    labels = np.arange(len(nodes))
    at_home, visiting = np.searchsorted(nodes, home), np.searchsorted(nodes, visitors)
    step = max(1, PAIRS_AT_ONCE // max(1, len(visitors)))
    for i in range(0, len(home), step):
        near = np.bitwise_count(home[i : i + step, None] ^ visitors[None, :]) <= distance
        a, b = np.nonzero(near)
        a, b = at_home[a + i], visiting[b]
        apart = labels[a] != labels[b]
        labels = _union(labels, a[apart], b[apart])
    linked = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[linked], nodes[labels[linked]]


def near_links(
    prints: DataFrame, covering: Covering, cell_rows: int = CELL_ROWS, home_rows: int = HOME_ROWS
) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints connected by near pairs.

    A cell has about ``cell_rows`` visitors and at most about ``home_rows`` fingerprints at home.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("print").to_numpy(zero_copy_only=False)
            for i in range(0, len(values), 1 << 14):
                some = values[i : i + (1 << 14)]
                places, anchors, homes = covering.visits(some.astype(np.uint64))
                yield pa.RecordBatch.from_pydict(
                    {"anchor": pa.array(anchors), "home": pa.array(homes), "print": pa.array(some[places])}
                )

    visits = shipped(prints.select("print")).mapInArrow(visit, "anchor long, home boolean, print long")
    # Anchors over cell_rows are cut into columns of visitors and, with very many at home, rows of those.  The
    # list of cut anchors has at most (number of visits / cell_rows) rows; Spark picks the join by its size.
    sizes = visits.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("home")).alias("n_home"))
    crowded = stored(
        sizes.where(F.col("n") > cell_rows).select(
            "anchor", F.ceil(F.col("n") / cell_rows).alias("columns"), F.ceil(F.col("n_home") / home_rows).alias("rows")
        ),
        "crowded",
    )

    def cuts(name: str) -> Column:
        return F.greatest(F.coalesce(name, F.lit(1).cast("long")), F.lit(1).cast("long"))

    def every(name: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), cuts(name) - 1)

    row, column = (F.pmod(F.xxhash64("print", F.lit(n)), cuts(name)) for n, name in ((1, "rows"), (2, "columns")))
    as_home = F.when(
        F.col("home"), F.transform(every("columns"), lambda c: F.struct(row.alias("r"), c.alias("c"), F.lit(True).alias("home")))
    )
    as_visitor = F.transform(every("rows"), lambda r: F.struct(r.alias("r"), column.alias("c"), F.lit(False).alias("home")))
    nothing = F.expr("cast(array() as array<struct<r: bigint, c: bigint, home: boolean>>)")
    cells = (
        visits.join(crowded, "anchor", "left")
        .select("anchor", "print", F.explode(F.concat(F.coalesce(as_home, nothing), as_visitor)).alias("cell"))
        .select("anchor", "print", "cell.r", "cell.c", "cell.home")
    )
    distance = covering.distance

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            names = [table.column(x).to_numpy(zero_copy_only=False) for x in ("anchor", "r", "c")]
            home = table.column("home").to_numpy(zero_copy_only=False)
            values = table.column("print").to_numpy(zero_copy_only=False).astype(np.uint64)
            edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
            found = [
                cell_links(values[a:b][home[a:b]], values[a:b][~home[a:b]], distance)
                for a, b in zip([0, *edges], [*edges, len(values)], strict=True)
                if home[a:b].any() and values[a:b].min() != values[a:b].max()
            ]
            if found:
                a, b = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    by = ["anchor", "r", "c"]
    return cells.repartition(*by).sortWithinPartitions(*by).mapInArrow(compare, "a long, b long")


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that never end within a cell, from batches in order of cells."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, new]).combine_chunks() if held else new
        of_last = np.ones(table.num_rows, bool)
        for name in ("anchor", "r", "c"):
            values = table.column(name).to_numpy()
            of_last &= values == values[-1]
        start = int(np.argmax(of_last))
        if start:
            yield table.slice(0, start)
        held = table.slice(start)
    if held:
        yield held


def _rooted(
    prints: DataFrame, covering: Covering, cell_rows: int = CELL_ROWS, home_rows: int = HOME_ROWS
) -> DataFrame:
    """Distinct fingerprints with the root of their component."""
    roots = components(near_links(prints, covering, cell_rows, home_rows)).select(F.col("a").alias("print"), "root")
    return prints.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))


def print_components(
    prints: DataFrame, covering: Covering = Covering(), cell_rows: int = CELL_ROWS, home_rows: int = HOME_ROWS
) -> DataFrame:
    """(print, component_id) for every distinct fingerprint of (doc_id, print)."""
    least = stored(prints.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "prints")
    rooted = _rooted(least, covering, cell_rows, home_rows)
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(names, "root").select("print", "component_id")


def simhash_components(docs: DataFrame, covering: Covering = Covering(), shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    # A fingerprint that very many documents share is a skewed key of a plain join, which adaptive
    # execution splits; each row is two numbers.
    return prints.join(print_components(prints, covering), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, covering: Covering = Covering(), shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with all its columns.

    It is the one with the least doc_id, null being larger than all others; where several texts
    have that doc_id, the one with the least fingerprint and text hash; where that row is repeated,
    the least by all columns.  Doc_ids only rank the documents of a component, so no two components
    meet in one id.  The list of the chosen grows with the documents, so it is merged.
    """
    key = ["doc_id", "h1", "h2"]
    prints = fingerprints(docs, shingle, hashed=True)
    rows = prints.groupBy("print", *key).agg(F.count(F.lit(1)).alias("n"))

    def least(*columns: str) -> Column:
        return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), *columns)).alias("first")

    of_prints = rows.groupBy("print").agg(least(*key, "n")).select("print", "first.*")
    rooted = _rooted(stored(of_prints, "prints"), covering)
    chosen = rooted.groupBy("root").agg(least("doc_id", "print", "h1", "h2", "n")).select("first.*")
    first = stored(chosen.select(*key, "n"), "first")

    keyed = docs.select(
        F.struct(*map(quoted, docs.columns)).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        *[h.alias(name) for name, h in _text_hashes().items()],
    )

    def among(some: DataFrame) -> DataFrame:
        same = [keyed[name].eqNullSafe(some[name]) for name in key]
        return keyed.join(some, same, "left_semi")

    once, repeated = (first.where(x).select(*key) for x in ("n = 1", "n > 1"))
    single = among(repeated).groupBy(*key).agg(F.min_by("doc", F.md5(F.to_json("doc").cast("binary"))).alias("doc"))
    kept = among(once.hint("merge")).select("doc").unionByName(single.select("doc"))
    return kept.select([F.col("doc")[name].alias(name) for name in docs.columns])
