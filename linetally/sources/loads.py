"""Loading rows into declared tables: good rows into the table, bad ones beside it with the reason.

Every row is judged by what the table declares: required columns, value domains, references to
parents, and the key, which may neither be in the table already nor come twice.  Accepted and
rejected rows appear in one step, as one batch of a snapshot.  A batch has a name, and a batch that is in
the table already is not loaded again; one that failed is simply loaded again.

The rows move once, into the folders they are stored in.  What judges them is found beforehand from
single columns and is small where the data is good: referenced values without a parent, and keys that
come twice or are known.  Parents and stored keys go through a Bloom filter before they are joined.

Rows with a repeated key that are good otherwise are set aside and settled afterwards: the first by its
columns, in their order, is accepted.  Equal rows are merged with a count before, so that a row that
makes up a third of a load is one row per task.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from linetally.functions.blooms import possibly_among
from linetally.sources import files, snapshots
from linetally.sources.schemas import TABLES, Reference, Table
from linetally.sources.tables import bloom_options, conform, with_folder_day

REASONS, VERDICT = "reasons", "verdict"
ACCEPTED, REJECTED, SUSPECT = "accepted", "rejected", "suspect"


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def rejects_of(table: Table) -> Table:
    """The table of rejected rows: the columns, none of them required, and why they were rejected."""
    reasons = StructField(REASONS, ArrayType(StringType()), True)
    schema = StructType([*nullable(table.schema).fields, reasons])
    return Table(f"{table.name}_rejects", schema, table.key, layout=table.layout)


def _as_given(rows: DataFrame, table: Table) -> DataFrame:
    """Declared columns; also required ones may be absent, and then are null."""
    absent = {name: F.lit(None) for name in table.required if name not in [*rows.columns, *table.defaults]}
    return conform(rows.withColumns(absent) if absent else rows, table)


def _known_nulls(table: Table) -> list[Column]:
    return [F.when(F.col(name).isNull(), f"null: {name}") for name in table.required]


def _outside(table: Table) -> list[Column]:
    return [F.when(~F.col(name).isin(*allowed), f"domain: {name}") for name, allowed in table.domains.items()]


def lost_values(
    given: DataFrame, references: list[Reference], parents: dict[str, DataFrame], scratch: str
) -> DataFrame:
    """(column_name, ref): referenced values that have no parent."""
    value = F.explode(
        F.array(*[F.struct(F.lit(r.column).alias("column_name"), F.col(r.column).cast("string").alias("ref")) for r in references])
    )
    spark = given.sparkSession
    used = given.select(value.alias("v")).select("v.*").where("ref is not null").distinct()
    used.write.parquet(f"{scratch}/used")
    used = spark.read.schema("column_name string, ref string").parquet(f"{scratch}/used")
    lost = []
    for r in references:
        of_column = used.where(F.col("column_name") == r.column)
        keys = parents[r.parent].select(F.col(r.parent_column).cast("string").alias("ref"))
        lost.append(of_column.join(possibly_among(keys, ["ref"], of_column, ["ref"]), "ref", "left_anti"))
    found = lost[0]
    for more in lost[1:]:
        found = found.unionByName(more)
    found.write.parquet(f"{scratch}/lost")
    return spark.read.schema("column_name string, ref string").parquet(f"{scratch}/lost")


def doubtful_keys(given: DataFrame, table: Table, stored: DataFrame | None, scratch: str) -> DataFrame:
    """The given keys that come twice or are stored already (``known``)."""
    spark, key = given.sparkSession, list(table.key)
    counts = given.select(*key).dropna().groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(f"{scratch}/keys")
    counts = spark.read.parquet(f"{scratch}/keys")
    doubtful = counts.where("n > 1").select(*key, F.lit(False).alias("known"))
    if stored is not None:
        among = possibly_among(stored.select(*key), key, counts, key)
        known = among.join(counts.select(*key), key, "left_semi").distinct()
        doubtful = doubtful.unionByName(known.withColumn("known", F.lit(True)))
    doubtful.groupBy(*key).agg(F.max("known").alias("known")).write.parquet(f"{scratch}/doubtful")
    return spark.read.parquet(f"{scratch}/doubtful")


def judged(given: DataFrame, table: Table, lost: DataFrame | None, doubtful: DataFrame) -> DataFrame:
    """The given rows with their reasons and verdict."""
    rows, faults = given, [*_known_nulls(table), *_outside(table)]
    if lost is not None:
        for n, r in enumerate(table.references):
            of_column = lost.where(F.col("column_name") == r.column).select(F.col("ref").alias(f"lost_{n}"))
            rows = rows.join(of_column, F.col(r.column).cast("string") == F.col(f"lost_{n}"), "left")
            faults.append(F.when(F.col(f"lost_{n}").isNotNull(), f"reference: {r.column}"))
    renamed = doubtful.select(*[F.col(c).alias(f"doubtful_{c}") for c in table.key], "known")
    same = [F.col(c) == F.col(f"doubtful_{c}") for c in table.key]
    rows = rows.join(renamed, same, "left")
    faults.append(F.when(F.col("known"), "key"))
    verdict = (
        F.when(F.size(REASONS) > 0, REJECTED).when(F.col("known").isNotNull(), SUSPECT).otherwise(ACCEPTED)
    )
    return rows.withColumn(REASONS, F.array_compact(F.array(*faults))).select(
        *table.schema.names, REASONS, verdict.alias(VERDICT)
    )


def settled(suspects: DataFrame, table: Table) -> DataFrame:
    """Of rows with equal keys the first is accepted, the others are rejected for their key."""
    names, key = table.schema.names, list(table.key)
    merged = suspects.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    first = merged.groupBy(*key).agg(F.min(F.struct(*names)).alias("first"))
    place = F.explode(F.sequence(F.lit(1), F.col("n")))
    taken = F.struct(*names).eqNullSafe(F.col("first")) & (F.col("place") == 1)
    return (
        merged.join(first, key)
        .withColumn("place", place)
        .select(
            *names,
            F.when(taken, F.array().cast("array<string>")).otherwise(F.array(F.lit("key"))).alias(REASONS),
            F.when(taken, ACCEPTED).otherwise(REJECTED).alias(VERDICT),
        )
    )


def _write(rows: DataFrame, table: Table, path: str, batch: str) -> None:
    out, column = with_folder_day(rows, table)
    (
        out.hint("rebalance", VERDICT, column)
        .sortWithinPartitions(VERDICT, column, *table.layout)
        .write.mode("overwrite")
        .options(**bloom_options(table))
        .partitionBy(VERDICT, column)
        .parquet(snapshots.batch_path(path, table, batch))
    )


def load_rows(
    rows: DataFrame,
    table: Table,
    path: str,
    batch: str,
    parents: dict[str, DataFrame] | None = None,
    grace_seconds: float = files.GRACE_SECONDS,
) -> bool:
    """Add a batch of rows to the table stored at a path; False if that batch is in it already.

    References are checked where ``parents`` are given.  The key is checked against the whole
    table, of which its columns only are read.
    """
    spark = rows.sparkSession
    base, rejects, of_keys = snapshots.current(spark, path), rejects_of(table), f"{batch}-keys"
    if any(f.batch in (batch, of_keys) for f in [*base.of(table), *base.of(rejects)]):
        return False
    scratch = f"{path}/scratch/{uuid.uuid4().hex}"
    try:
        given = _as_given(rows, table)
        checked = table.references if parents is not None else ()
        lost = lost_values(given, list(checked), parents, scratch) if checked else None
        stored = snapshots.read_table(spark, path, table, base) if base.of(table) else None
        doubtful = doubtful_keys(given, table, stored, scratch)
        _write(judged(given, table, lost, doubtful), table, path, batch)
        suspects = snapshots.folders_of(spark, table, path, batch, f"/{VERDICT}={SUSPECT}")
        batches = [batch]
        if suspects:
            set_aside = snapshots.read(spark, path, suspects, nullable(table.schema))
            _write(settled(set_aside, table), table, path, of_keys)
            batches.append(of_keys)
    finally:
        files.remove(spark, scratch)

    def stored_as(verdict: str, name: str) -> list[snapshots.Folder]:
        found = [f for b in batches for f in snapshots.folders_of(spark, table, path, b, f"/{VERDICT}={verdict}")]
        return [f._replace(table=name) for f in found]

    fresh = [*stored_as(ACCEPTED, table.name), *stored_as(REJECTED, rejects.name)]
    snapshots.publish(spark, path, base, [*base.folders, *fresh], grace_seconds)
    return True


def read_rejects(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """What was rejected from a table so far: its columns and the reasons."""
    rejects = rejects_of(table)
    return snapshots.read(spark, path, snapshots.existing(spark, path).of(rejects), rejects.schema)


def load_folder(spark: SparkSession, folder: str, path: str, batch: str) -> dict[str, bool]:
    """Load a batch of all tables that have a Parquet folder in ``folder``; says which were new.

    Parents come before their children, so that rows may refer to others of the same batch.  Every table
    changes in one step; a batch that stopped between two tables is loaded on from there.
    """
    loaded = {}
    for name, table in TABLES.items():
        if files.exists(spark, f"{folder}/{name}"):
            base = snapshots.current(spark, path)
            parents = {r.parent: snapshots.read_table(spark, path, TABLES[r.parent], base) for r in table.references}
            loaded[name] = load_rows(spark.read.parquet(f"{folder}/{name}"), table, path, batch, parents)
    return loaded


def days_of(spark: SparkSession, path: str, batch: str, *tables: Table) -> tuple[datetime.date, datetime.date] | None:
    """The first and the last day that a batch has accepted rows of these tables for."""
    snapshot = snapshots.existing(spark, path)
    found = [f.day for t in tables for f in snapshot.of(t) if f.batch in (batch, f"{batch}-keys") and f.day]
    return (min(found), max(found)) if found else None
