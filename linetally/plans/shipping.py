"""On-time shipping, by requested date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.functions import days_back, rounded_ratio, rows_since
from linetally.functions.times import AsOf

ON_TIME = "actual_ship_date <= requested_ship_date"


def _recent(shipments: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return rows_since(shipments, "requested_ship_date", days_back(as_of, days))


def _tally() -> list[Column]:
    late = F.date_diff("actual_ship_date", "requested_ship_date")
    return [
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(F.expr(ON_TIME)).alias("on_time"),
        F.sum(F.greatest(late, F.lit(0))).alias("days_late"),
    ]


def on_time_overall(shipments: DataFrame, as_of: AsOf = None, days: int = 60) -> DataFrame:
    """One row: on-time rate (null without shipments) and number of shipments."""
    return (
        _recent(shipments, as_of, days)
        .agg(*_tally())
        .select(rounded_ratio(F.col("on_time"), F.col("shipments"), 4).alias("on_time_rate"), "shipments")
    )


def on_time_by_customer(
    shipments: DataFrame, customers: DataFrame, as_of: AsOf = None, days: int = 60
) -> DataFrame:
    """Shipments, on-time rate and mean days late by customer name; early counts as 0 days.

    Shipments are summed per customer id before the join; ids with equal names then merge.
    """
    return (
        _recent(shipments, as_of, days)
        .groupBy("customer_id")
        .agg(*_tally())
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_name")
        .agg(*[F.sum(measure).alias(measure) for measure in ("shipments", "on_time", "days_late")])
        .select(
            "customer_name",
            "shipments",
            rounded_ratio(F.col("on_time"), F.col("shipments"), 4).alias("on_time_rate"),
            rounded_ratio(F.col("days_late"), F.col("shipments"), 2).alias("avg_days_late"),
        )
        .orderBy(
            F.asc_nulls_last("on_time_rate"), F.desc_nulls_first("shipments"), F.asc_nulls_last("customer_name")
        )
    )
