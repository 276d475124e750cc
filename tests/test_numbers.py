from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from linetally.functions import minutes, ratio, rounded_ratio
from linetally.plans.downtime import downtime_pareto
from linetally.sources.tables import reason_codes


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("part", "whole", "digits", "expected"),
    [
        (1, 32, 4, 0.0313),  # 0.03125: a half goes up
        (-1, 32, 4, -0.0313),  # away from zero
        (201, 200, 2, 1.01),  # 1.005, which no double holds
        (2, 3, 4, 0.6667),
        (1, 0, 4, None),
        (None, 5, 4, None),
        (10**18, 3, 2, 333333333333333333.33),
    ],
)
def test_rounding(spark, part, whole, digits, expected):
    assert value(spark, rounded_ratio(F.lit(part).cast("bigint"), F.lit(whole), digits)) == expected


def test_minutes(spark):
    assert value(spark, minutes(F.lit(300_000))) == Decimal("0.01")  # half a hundredth
    assert value(spark, minutes(F.lit(299_999))) == Decimal("0.00")
    assert value(spark, minutes(F.lit("9" * 24).cast("decimal(24,0)"))) > 10**16
    assert value(spark, ratio(F.lit(1), F.lit(3))) == Decimal("0.33333333333333")


def test_totals_beyond_bigint(spark):
    """The downtime of a very large fleet exceeds 64-bit microseconds."""
    month_us = 30 * 86_400_000_000
    time = spark.range(8).select(
        F.col("id").cast("int").alias("machine_id"),
        F.lit("2024-01-10").cast("date").alias("day"),
        F.lit("MECH").alias("reason_code"),
        F.lit(0).cast("bigint").alias("run_us"),
        F.lit(month_us * 3_000_000).cast("bigint").alias("stop_us"),
    )
    row = downtime_pareto(time, reason_codes(spark), "2024-01-30").first()
    assert month_us * 3_000_000 * 8 > 2**63
    assert row.downtime_min == Decimal(30 * 1440 * 3_000_000 * 8) and row.share == 1.0
