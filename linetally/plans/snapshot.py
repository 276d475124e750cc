"""Reports on the daily line KPI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.functions import days_back
from linetally.functions.times import AsOf


def kpi_snapshot(mart: DataFrame, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """All line-days from the last days on, newest first."""
    recent = mart.where(F.col("day") >= days_back(as_of, days))
    return recent.orderBy(F.desc_nulls_first("day"), F.asc_nulls_last("line_id"))


def throughput_rank(
    mart: DataFrame, as_of: AsOf = None, days: int = 30, n: int = 15, best: bool = True
) -> DataFrame:
    """The n line-days with the best or worst throughput; equal ones by day and line."""
    rate = F.col("throughput_per_hour")
    return (
        mart.where((F.col("day") >= days_back(as_of, days)) & rate.isNotNull())
        .select(
            "day",
            "line_id",
            "throughput_per_hour",
            "runtime_min",
            "downtime_min",
            "good_qty",
            "scrap_qty",
            "yield",
        )
        .orderBy(
            rate.desc_nulls_first() if best else rate.asc_nulls_last(),
            F.asc_nulls_last("day"),
            F.asc_nulls_last("line_id"),
        )
        .limit(n)
    )
