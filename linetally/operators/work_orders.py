"""Linking machine events to the work orders of their line and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LINE_DAY = ["line_id", "day"]
# Runs of a line-day are numbered in slices of this many ids, so no task needs all of them.
IDS_PER_SLICE = 1_000_000


def numbered_runs(runs: DataFrame, ids_per_slice: int = IDS_PER_SLICE) -> DataFrame:
    """(line_id, day, pick, assigned): the runs starting on a line and day, numbered by id from 0.

    Numbers start anew in each slice of ids; a table with one row per slice gives the number
    at which a slice begins.
    """
    piece = [*LINE_DAY, "slice"]
    starts = runs.select(
        "line_id",
        F.to_date("actual_start_ts").alias("day"),
        F.call_function("div", "work_order_id", F.lit(ids_per_slice).cast("bigint")).alias("slice"),
        F.col("work_order_id").alias("assigned"),
    ).where("line_id is not null and day is not null")
    before = Window.partitionBy(*LINE_DAY).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        starts.groupBy(*piece)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*piece, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_pick"))
    )
    place = F.row_number().over(Window.partitionBy(*piece).orderBy("assigned"))
    return (
        starts.withColumn("place", place)
        .join(slices, piece)
        .select(*LINE_DAY, (F.col("first_pick") + F.col("place") - 1).cast("bigint").alias("pick"), "assigned")
    )


def assign_work_order(
    events: DataFrame, machines: DataFrame, runs: DataFrame, ids_per_slice: int = IDS_PER_SLICE
) -> DataFrame:
    """Events with work_order_id set to one run that starts on the event's line and day.

    With the candidates numbered by work order from 0, event e takes number
    e mod (number of candidates); null if there is none.

    Machines, and the number of candidates per line and day, are small next to the log; Spark
    broadcasts them if they measure so.  Then events move once, to the candidates.  That is a
    plain join on line, day and number: where few runs stand against very many events,
    adaptive execution splits the events of a number over several tasks.
    """
    candidates = numbered_runs(runs, ids_per_slice)
    n_runs = (
        runs.groupBy("line_id", F.to_date("actual_start_ts").alias("day"))
        .agg(F.count("work_order_id").alias("n_runs"))
        .where("n_runs > 0")
    )
    return (
        events.drop("work_order_id")
        .withColumn("day", F.to_date("event_ts"))
        .join(machines.select("machine_id", "line_id"), "machine_id", "left")
        .join(n_runs, LINE_DAY, "left")
        .withColumn("pick", F.pmod("event_id", "n_runs"))
        .join(candidates, [*LINE_DAY, "pick"], "left")
        .select(
            "event_id",
            "machine_id",
            "event_ts",
            "state",
            "reason_code",
            F.col("assigned").alias("work_order_id"),
        )
    )
