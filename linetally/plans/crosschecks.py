"""Mismatches between the event log and production."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.operators.line_day import line_output_daily, line_time_daily


def log_vs_output_check(machine_time: DataFrame, machines: DataFrame, runs: DataFrame) -> DataFrame:
    """Number of line-days per class.

    NO_OUTPUT has events but no run, NO_EVENTS a run but no event, RUNTIME_ZERO_WITH_OUTPUT
    both but output without running time; all others are OK.
    """
    time = line_time_daily(machine_time, machines).withColumn("has_events", F.lit(True))
    output = line_output_daily(runs).withColumn("has_output", F.lit(True))
    made = F.col("good_qty") + F.col("scrap_qty")
    status = (
        F.when(F.col("has_output").isNull(), "NO_OUTPUT")
        .when(F.col("has_events").isNull(), "NO_EVENTS")
        .when((F.col("run_us") == 0) & (made > 0), "RUNTIME_ZERO_WITH_OUTPUT")
        .otherwise("OK")
    )
    return (
        time.join(output, ["line_id", "day"], "full")
        .groupBy(status.alias("status"))
        .agg(F.count(F.lit(1)).alias("line_days"))
        .orderBy(F.asc_nulls_last("status"))
    )
