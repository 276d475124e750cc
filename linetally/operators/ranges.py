"""Work along one order of all rows, in ranges of it that are equal in size.

Rows are sorted over all partitions: each holds a range of the order, bounded by values that Spark
draws from a sample, so that a key with any share of the rows is spread over as many
tasks as it needs.  What crosses the ranges is one row per range: its number of rows, or its first.
Sorted rows are stored before anything is added up over the ranges, as a task that is run again may
cut them elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType, TimestampNTZType

from linetally.operators.intervals import duration_us

AT = "stored_at"
# Spark numbers the rows of a partition in the lower bits, partitions in the upper ones.
ROW_BITS = 33


def store_ordered(rows: DataFrame, path: str) -> None:
    """Store rows that are sorted over all partitions, as ``orderBy`` leaves them, with their places."""
    rows.withColumn(AT, F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, name: str = "place") -> DataFrame:
    """The stored rows with their places 1, 2, ... without gaps; sort by them to get the order back.

    The number of rows per range is summed up over a table with one row per task that stored it,
    which is broadcast.
    """
    rows = spark.read.parquet(path)
    split = rows.withColumns(
        {"range_id": F.shiftright(AT, ROW_BITS), "row_in_range": F.col(AT).bitwiseAND(F.lit((1 << ROW_BITS) - 1))}
    )
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    counts = split.groupBy("range_id").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("range_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = (F.col("start") + F.col("row_in_range") + 1).cast("bigint")
    kept = [F.col(f"`{c}`") for c in rows.columns if c != AT]
    return split.join(F.broadcast(starts), "range_id").select(*kept, place.alias(name))


def numbered(rows: DataFrame, order: list[str], path: str, name: str = "place") -> DataFrame:
    """rows numbered 1, 2, ... in an order, without a window over all of them.

    They are stored at a path; the numbers do not change afterwards.
    """
    store_ordered(rows.orderBy(*order), path)
    return read_ordered(rows.sparkSession, path, name)


def with_successors(events: DataFrame, path: str) -> DataFrame:
    """Events with ``next_ts``, the time of the machine's next event, or null for its last.

    Within a range a stream compares each event with the one behind it; the last event of a range
    takes its successor from the first of the next.  Events move once, and are stored at the path.
    """
    return _in_ranges(events, path).drop("range_id")


def _in_ranges(events: DataFrame, path: str) -> DataFrame:
    """``with_successors`` and the range that each event lies in."""
    spark = events.sparkSession
    stored = StructType(
        [
            *events.schema.fields,
            StructField("next_ts", TimestampNTZType()),
            StructField("range_id", IntegerType()),
            StructField("is_first", BooleanType()),
            StructField("is_last", BooleanType()),
        ]
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        range_id = TaskContext.get().partitionId()

        def marked(rows: pa.Table, next_ts: pa.Array, first: bool, last: bool) -> list[pa.RecordBatch]:
            n = rows.num_rows
            rows = rows.append_column("next_ts", next_ts)
            rows = rows.append_column("range_id", pa.array([range_id] * n, pa.int32()))
            rows = rows.append_column("is_first", pa.array([first and i == 0 for i in range(n)], pa.bool_()))
            rows = rows.append_column("is_last", pa.array([last] * n, pa.bool_()))
            return rows.combine_chunks().to_batches()

        held, started = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            n = rows.num_rows
            if n > 1:
                machine, ts = rows.column("machine_id"), rows.column("event_ts")
                one, other = machine.slice(0, n - 1), machine.slice(1)
                both_null = pc.and_(pc.is_null(one), pc.is_null(other))
                same = pc.or_(pc.fill_null(pc.equal(one, other), False), both_null)
                next_ts = pc.if_else(same, ts.slice(1), pa.scalar(None, ts.type))
                yield from marked(rows.slice(0, n - 1), next_ts, not started, False)
                started = True
            held = rows.slice(n - 1, 1)
        if held is not None:
            none = pa.nulls(1, held.column("event_ts").type)
            yield from marked(held, none, not started, True)

    order = ["machine_id", "event_ts", "event_id"]
    sorted_events = events.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_events.mapInArrow(follow, stored).write.mode("overwrite").parquet(path)
    rows = spark.read.schema(stored).parquet(path)
    by_range = Window.orderBy("range_id")
    firsts = rows.where("is_first").select(
        "range_id",
        F.lead("machine_id").over(by_range).alias("seam_machine"),
        F.lead("event_ts").over(by_range).alias("seam_ts"),
        F.lead(F.lit(True)).over(by_range).alias("seam"),
    )
    continues = F.col("is_last") & F.col("seam") & F.col("seam_machine").eqNullSafe(F.col("machine_id"))
    # One row per range; there are no more ranges than shuffle partitions.
    return rows.join(F.broadcast(firsts), "range_id").select(
        *events.columns, F.when(continues, F.col("seam_ts")).otherwise(F.col("next_ts")).alias("next_ts"), "range_id"
    )


def state_intervals_by_range(events: DataFrame, machines: DataFrame, path: str) -> DataFrame:
    """What ``intervals.state_intervals`` returns, however the log is spread over machines and days.

    For logs where single days of a machine are too long for a task, without saying beforehand
    how long.  Sorted events are stored at the path.  Lines come to the machines of each range, so that
    one machine's events are not brought together for them either.
    """
    rows = _in_ranges(events, path)
    found = events.sparkSession.read.parquet(path).select("range_id", "machine_id").distinct()
    lines = found.join(machines.select("machine_id", "line_id"), "machine_id")
    return (
        rows.join(lines, ["range_id", "machine_id"])
        .select(
            "event_id",
            "machine_id",
            "line_id",
            F.to_date("event_ts").alias("day"),
            "state",
            "reason_code",
            "event_ts",
            "next_ts",
            duration_us().alias("duration_us"),
        )
    )
