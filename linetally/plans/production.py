"""Output by product family and line.

Runs are summed per product before they meet the product dimension, so the join moves
sums and a product with very many runs weighs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.functions import days_back, micros_between, rounded_ratio, rows_since
from linetally.functions.numbers import MICROS_PER_MINUTE
from linetally.functions.times import AsOf


def _recent(runs: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return rows_since(runs, "actual_end_ts", days_back(as_of, days))


def _by_family(runs: DataFrame, products: DataFrame, key: Column, name: str) -> DataFrame:
    per_product = runs.groupBy(key.alias(name), "product_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("good_qty").alias("good_qty"),
        F.sum("scrap_qty").alias("scrap_qty"),
    )
    return (
        per_product.join(products.select("product_id", "product_family"), "product_id")
        .groupBy(name, "product_family")
        .agg(*[F.sum(measure).alias(measure) for measure in ("runs", "good_qty", "scrap_qty")])
    )


def output_by_family_day(
    runs: DataFrame, products: DataFrame, as_of: AsOf = None, days: int = 30
) -> DataFrame:
    """Good, scrap and yield by day of actual end and product family."""
    made = F.col("good_qty") + F.col("scrap_qty")
    return (
        _by_family(_recent(runs, as_of, days), products, F.to_date("actual_end_ts"), "day")
        .select(
            "day",
            "product_family",
            "good_qty",
            "scrap_qty",
            rounded_ratio(F.col("good_qty"), made, 4).alias("yield"),
        )
        .orderBy(F.desc_nulls_first("day"), F.asc_nulls_last("product_family"))
    )


def line_product_mix(
    runs: DataFrame, products: DataFrame, as_of: AsOf = None, days: int = 30
) -> DataFrame:
    """Number of runs, good and scrap by line and product family."""
    return (
        _by_family(_recent(runs, as_of, days), products, F.col("line_id"), "line_id")
        .select("line_id", "product_family", "runs", "good_qty", "scrap_qty")
        .orderBy(
            F.asc_nulls_last("line_id"), F.desc_nulls_first("good_qty"), F.asc_nulls_last("product_family")
        )
    )


def schedule_adherence(runs: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """How closely runs kept to plan, by line and day of actual end.

    Delays are means in minutes, negative when early; on_time_share counts the runs that
    ended no later than planned.
    """
    delays = _recent(runs, as_of, days).select(
        "line_id",
        F.to_date("actual_end_ts").alias("day"),
        micros_between(F.col("planned_start_ts"), F.col("actual_start_ts")).alias("start_us"),
        micros_between(F.col("planned_end_ts"), F.col("actual_end_ts")).alias("end_us"),
    )
    mean_base = F.col("runs") * MICROS_PER_MINUTE
    return (
        delays.groupBy("line_id", "day")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("start_us").alias("start_us"),
            F.sum("end_us").alias("end_us"),
            F.count_if(F.col("end_us") <= 0).alias("on_time"),
        )
        .select(
            "line_id",
            "day",
            "runs",
            rounded_ratio(F.col("start_us"), mean_base, 2).alias("avg_start_delay_min"),
            rounded_ratio(F.col("end_us"), mean_base, 2).alias("avg_end_delay_min"),
            rounded_ratio(F.col("on_time"), F.col("runs"), 4).alias("on_time_share"),
        )
        .orderBy(F.desc_nulls_first("day"), F.asc_nulls_last("line_id"))
    )
