"""Reading and writing the declared tables as Parquet, and the reason-code rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from linetally.functions.times import STORED_DAY
from linetally.sources.schemas import EVENTS, REASONS, TABLES, Table

# Reason codes with category and description.
REASON_ROWS = [
    ("MECH", "MECH", "Mechanical failure"),
    ("ELEC", "ELEC", "Electrical issue"),
    ("CHNG", "CHANGEOVER", "Changeover/setup"),
    ("MTRL", "MATERIAL", "Material shortage/quality"),
    ("QUAL", "QUALITY", "Quality hold"),
    ("PLAN", "PLANNING", "Planning/starvation"),
]


def reason_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REASON_ROWS, REASONS.schema)


def fill_defaults(rows: DataFrame, table: Table) -> DataFrame:
    """Add columns that rows lack and that have a declared default.

    A null that is given stays; for a required column ``not_null_violations`` reports it.
    """
    absent = {name: F.lit(value) for name, value in table.defaults.items() if name not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """Declared columns in declared order and type; absent ones get their default or null.

    A required column without a default has to be there.
    """
    filled = fill_defaults(rows, table)

    def value(field: StructField) -> Column:
        absent = field.nullable and field.name not in filled.columns
        return F.lit(None) if absent else F.col(field.name)

    return filled.select(*[value(f).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def _folder_day(table: Table) -> Column:
    return F.to_date(table.layout[0]).alias(STORED_DAY)


def with_folder_day(rows: DataFrame, table: Table) -> tuple[DataFrame, str]:
    """rows with the column that their folders are named by, and its name.

    Tables without dates have one folder, of no day.
    """
    if "day" in table.schema.names:
        return rows, "day"
    day = _folder_day(table) if table.layout else F.lit(None).cast("date")
    return rows.withColumn(STORED_DAY, day), STORED_DAY


def bloom_options(table: Table) -> dict[str, str]:
    """Writer options for Bloom filters on the columns that single rows are looked up by.

    Each row group gets the smallest filter that its values need.
    """
    options = {"parquet.bloom.filter.adaptive.enabled": "true"} if table.lookups else {}
    return {**options, **{f"parquet.bloom.filter.enabled#{name}": "true" for name in table.lookups}}


def look_up(rows: DataFrame, column: str, values: Sequence[int]) -> DataFrame:
    """The rows of a stored table whose column has one of some values.

    Single comparisons reach the Parquet reader, which skips row groups by their Bloom filters
    and bounds; lists of values would only reach it as a range.
    """
    wanted = [F.col(column) == F.lit(value) for value in sorted(set(values))]
    return rows.where(reduce(Column.__or__, wanted, F.lit(False)))


def save_table(rows: DataFrame, root: str, table: Table, mode: str = "overwrite") -> None:
    """Write rows (``append`` inserts); tables with dates get a folder per day.

    Rebalancing gathers small days into few files and splits large ones over many tasks.
    """
    out = conform(rows, table)
    if not table.layout:
        out.write.mode(mode).options(**bloom_options(table)).parquet(f"{root}/{table.name}")
        return
    (
        out.withColumn(STORED_DAY, _folder_day(table))
        .hint("rebalance", STORED_DAY)
        .sortWithinPartitions(STORED_DAY, *table.layout)
        .write.mode(mode)
        .options(**bloom_options(table))
        .partitionBy(STORED_DAY)
        .parquet(f"{root}/{table.name}")
    )


def save_event_log(events: DataFrame, name: str, path: str, buckets: int, spread: int = 4) -> None:
    """Store events as a catalog table bucketed by machine and sorted by time.

    Queries on intervals then read each machine's log in place of shuffling it.  ``spread``
    tasks share a bucket, each with some of its days, so one machine does not load one task.
    """
    bucket = F.pmod(F.hash("machine_id"), F.lit(buckets))
    part = F.pmod(F.unix_date(F.to_date("event_ts")), F.lit(spread))
    (
        conform(events, EVENTS)
        .repartition(buckets * spread, bucket, part)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "machine_id")
        .sortBy("machine_id", "event_ts", "event_id")
        .saveAsTable(name)
    )


def save_by_order(rows: DataFrame, table: Table, name: str, path: str, buckets: int) -> None:
    """Store a table with work orders as a catalog table bucketed and sorted by them.

    Tables stored with the same number of buckets are joined on the order where they lie.
    """
    (
        conform(rows, table)
        .repartition(buckets, "work_order_id")
        .write.mode("overwrite")
        .option("path", path)
        .options(**bloom_options(table))
        .bucketBy(buckets, "work_order_id")
        .sortBy("work_order_id")
        .saveAsTable(name)
    )


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """A stored table; one with dates has its folder's day as a further column, ``stored_day``.

    Reports filter on it beside the time, so that they only open the folders they need.
    """
    schema = table.schema
    if table.layout:
        schema = StructType([*schema.fields, StructField(STORED_DAY, DateType(), True)])
    return spark.read.schema(schema).parquet(f"{root}/{table.name}")


def load_tables(spark: SparkSession, root: str, event_log: str | None = None) -> dict[str, DataFrame]:
    """All tables; the events from a bucketed catalog table if one is named."""
    tables = {name: read_table(spark, root, table) for name, table in TABLES.items()}
    return tables if event_log is None else {**tables, EVENTS.name: spark.table(event_log)}


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their declared names."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
