"""QC fail rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.functions import days_back, rounded_ratio, rows_since
from linetally.functions.times import AsOf


def _recent(qc: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return rows_since(qc, "sample_ts", days_back(as_of, days))


def _tally() -> list[Column]:
    return [F.count(F.lit(1)).alias("samples"), F.count_if(~F.col("in_spec")).alias("fails")]


def _fail_rate() -> Column:
    return rounded_ratio(F.col("fails"), F.col("samples"), 4).alias("fail_rate")


def qc_line_day_tally(qc: DataFrame, runs: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Samples and fails by the line of the work order and the day of the sample.

    Samples move once, three columns wide, to their work order; where one order has very many
    samples, adaptive execution splits them over several tasks.  Both reports by line and day
    start from this table.
    """
    samples = _recent(qc, as_of, days).select("work_order_id", F.to_date("sample_ts").alias("day"), "in_spec")
    return (
        samples.join(runs.select("work_order_id", "line_id"), "work_order_id")
        .groupBy("line_id", "day")
        .agg(*_tally())
    )


def qc_line_day_tally_by_order(qc: DataFrame, runs: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """``qc_line_day_tally`` for tables stored by ``save_by_order``: no sample moves.

    Samples are summed per order and day where they are read, meet their order there, and
    move as sums per line and day.  A bucket is read by one task: where a single order may have a large share of
    all samples, use the plain form, whose join is split.
    """
    per_order = (
        _recent(qc, as_of, days)
        .groupBy("work_order_id", F.to_date("sample_ts").alias("day"))
        .agg(*_tally())
    )
    return (
        per_order.join(runs.select("work_order_id", "line_id"), "work_order_id")
        .groupBy("line_id", "day")
        .agg(F.sum("samples").alias("samples"), F.sum("fails").alias("fails"))
    )


def qc_fail_by_test(qc: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    return (
        _recent(qc, as_of, days)
        .groupBy("test_type")
        .agg(*_tally())
        .select("test_type", "samples", "fails", _fail_rate())
        .orderBy(
            F.desc_nulls_first("fail_rate"), F.desc_nulls_first("samples"), F.asc_nulls_last("test_type")
        )
    )


def qc_fail_by_line_day(tally: DataFrame) -> DataFrame:
    """The fail rate of each row of ``qc_line_day_tally``."""
    return tally.select("line_id", "day", "samples", "fails", _fail_rate()).orderBy(
        F.desc_nulls_first("day"), F.asc_nulls_last("line_id")
    )


def qc_vs_yield(tally: DataFrame, mart: DataFrame) -> DataFrame:
    """QC fail rate next to the yield of the same line and day."""
    return (
        tally.join(mart.select("line_id", "day", "yield"), ["line_id", "day"])
        .select("line_id", "day", "samples", "fails", _fail_rate(), "yield")
        .orderBy(F.desc_nulls_first("day"), F.asc_nulls_last("line_id"))
    )
