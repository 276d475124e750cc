"""The daily line KPI: machine time and output per line and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetally.functions import micros_between, minutes, rows_since
from linetally.functions.numbers import MICROS_PER_HOUR
from linetally.operators.intervals import DAY_US, duration_us, piece_keys, time_in, with_successor


def machine_day_parts(
    events: DataFrame, since: Column | None = None, slice_us: int = DAY_US
) -> DataFrame:
    """What the events of each machine and day say by themselves, per reason code.

    Running and stopped microseconds without the last interval of the piece, which ends on a
    later day; the first event; and, in the row of its reason, time and state of the last.
    A row depends on no other day, so parts can be stored and replaced day by day.
    """
    if since is not None:
        events = rows_since(events, "event_ts", since)
    last = F.col("next_ts").isNull()
    return (
        with_successor(events, slice_us)
        .withColumn("duration_us", duration_us())
        .groupBy(*piece_keys(slice_us), "reason_code")
        .agg(
            time_in("RUN").alias("run_us"),
            time_in("STOP").alias("stop_us"),
            F.min("event_ts").alias("first_ts"),
            F.max(F.when(last, F.col("event_ts"))).alias("last_ts"),
            F.max(F.when(last, F.col("state"))).alias("last_state"),
        )
    )


def closed_machine_time(parts: DataFrame) -> DataFrame:
    """Running and stopped microseconds per machine, day and reason code, from their parts.

    The last interval of a piece ends at the machine's first event on any later one.  The window
    sees a few rows per machine and day.
    """
    place = F.col("slice") if "slice" in parts.columns else F.unix_date("day")
    later = (
        Window.partitionBy("machine_id").orderBy(place.desc()).rangeBetween(Window.unboundedPreceding, -1)
    )
    open_us = micros_between(F.col("last_ts"), F.min("first_ts").over(later))

    def plus_last(name: str, state: str) -> Column:
        added = F.when(F.col("last_state") == state, F.greatest("open_us", F.lit(0)))
        return F.col(name) + F.coalesce(added, F.lit(0))

    closed = parts.withColumn("open_us", open_us).select(
        "machine_id",
        "day",
        "reason_code",
        plus_last("run_us", "RUN").alias("run_us"),
        plus_last("stop_us", "STOP").alias("stop_us"),
    )
    if "slice" not in parts.columns:
        return closed
    return closed.groupBy("machine_id", "day", "reason_code").agg(
        F.sum("run_us").alias("run_us"), F.sum("stop_us").alias("stop_us")
    )


def machine_time_daily(
    events: DataFrame, since: Column | None = None, slice_us: int = DAY_US
) -> DataFrame:
    """Running and stopped microseconds per machine, day and reason code.

    All reports on machine time start here.  The log is shuffled once, by machine and day, for
    the window and the sums; only sums move after that.

    ``since`` keeps days from that date on and prunes the scan: an event's successor is never
    earlier than the event, so a lower bound may go below the window.
    """
    return closed_machine_time(machine_day_parts(events, since, slice_us))


def line_time_daily(machine_time: DataFrame, machines: DataFrame) -> DataFrame:
    """Running and stopped microseconds per line and day, summed over the line's machines.

    Machines without a dimension row drop out.
    """
    return (
        machine_time.join(machines.select("machine_id", "line_id"), "machine_id")
        .groupBy("line_id", "day")
        .agg(F.sum("run_us").alias("run_us"), F.sum("stop_us").alias("stop_us"))
    )


def line_output_daily(runs: DataFrame) -> DataFrame:
    """Good and scrap quantity per line and day of the actual end."""
    return runs.groupBy("line_id", F.to_date("actual_end_ts").alias("day")).agg(
        F.sum("good_qty").alias("good_qty"), F.sum("scrap_qty").alias("scrap_qty")
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def line_day_kpi(
    machine_time: DataFrame, machines: DataFrame, runs: DataFrame, since: Column | None = None
) -> DataFrame:
    """One row per line and day seen in the event log or in production.

    ``since`` keeps days from that date on; ``machine_time`` computed for this one call should
    be given the same bound.
    """
    if since is not None:
        machine_time = machine_time.where(F.col("day") >= since)
        runs = rows_since(runs, "actual_end_ts", since)
    cells = (
        line_time_daily(machine_time, machines)
        .join(line_output_daily(runs), ["line_id", "day"], "full")
        .select(
            "line_id",
            "day",
            *[_or_zero(name).alias(name) for name in ("run_us", "stop_us", "good_qty", "scrap_qty")],
        )
    )
    good, run = F.col("good_qty").cast("double"), F.col("run_us").cast("double")
    made = F.col("good_qty") + F.col("scrap_qty")
    return cells.select(
        "line_id",
        "day",
        minutes(F.col("run_us")).cast("decimal(12,2)").alias("runtime_min"),
        minutes(F.col("stop_us")).cast("decimal(12,2)").alias("downtime_min"),
        "good_qty",
        "scrap_qty",
        F.when(made != 0, good / made.cast("double")).alias("yield"),
        F.when((made != 0) & (run != 0), good * float(MICROS_PER_HOUR) / run).alias("throughput_per_hour"),
    )
