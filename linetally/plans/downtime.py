"""Downtime by reason, from machine time per day and reason code.

Running events take part with 0 minutes and no reason, so the UNKNOWN category is
present whenever there are events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linetally.functions import days_back, minutes, rounded_ratio
from linetally.functions.times import AsOf

NO_REASON = "UNKNOWN"


def _recent(machine_time: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Sums turn decimal here: over a whole fleet they may pass the range of bigint."""
    return machine_time.where(F.col("day") >= days_back(as_of, days)).withColumn(
        "stop_us", F.col("stop_us").cast("decimal(24,0)")
    )


def _by_category(stops: DataFrame, reasons: DataFrame, *keys: str) -> DataFrame:
    """Stopped time per category; stops without a known reason fall under UNKNOWN."""
    category = F.coalesce("reason_category", F.lit(NO_REASON)).alias("reason_category")
    return (
        stops.groupBy(*keys, "reason_code")
        .agg(F.sum("stop_us").cast("decimal(24,0)").alias("stop_us"))
        .join(reasons.select("reason_code", "reason_category"), "reason_code", "left")
        .groupBy(*keys, category)
        .agg(F.sum("stop_us").alias("stop_us"))
    )


def downtime_pareto(
    machine_time: DataFrame, reasons: DataFrame, as_of: AsOf = None, days: int = 30
) -> DataFrame:
    """Stop minutes by reason category with share and cumulative share of the total.

    Categories with equal downtime share one cumulative value.  The two windows see one row
    per reason category, so a single partition is enough.
    """
    stops = _by_category(_recent(machine_time, as_of, days), reasons)
    total = F.sum("stop_us").over(Window.partitionBy())
    so_far = F.sum("stop_us").over(Window.orderBy(F.desc("stop_us")))
    return (
        stops.withColumns({"total_us": total, "so_far_us": so_far})
        .select(
            "reason_category",
            minutes(F.col("stop_us")).alias("downtime_min"),
            rounded_ratio(F.col("stop_us"), F.col("total_us"), 4).alias("share"),
            rounded_ratio(F.col("so_far_us"), F.col("total_us"), 4).alias("cumulative_share"),
        )
        .orderBy(F.desc_nulls_first("downtime_min"), F.asc_nulls_last("reason_category"))
    )


def downtime_by_line_reason(
    machine_time: DataFrame,
    machines: DataFrame,
    reasons: DataFrame,
    as_of: AsOf = None,
    days: int = 30,
) -> DataFrame:
    """Stop minutes by line and reason category; machines without a dimension row drop out."""
    per_line = _recent(machine_time, as_of, days).join(
        machines.select("machine_id", "line_id"), "machine_id"
    )
    return (
        _by_category(per_line, reasons, "line_id")
        .select("line_id", "reason_category", minutes(F.col("stop_us")).alias("downtime_min"))
        .orderBy(
            F.asc_nulls_last("line_id"), F.desc_nulls_first("downtime_min"), F.asc_nulls_last("reason_category")
        )
    )
