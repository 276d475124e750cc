"""Exact ratios and rounding.

Durations are summed as whole microseconds, so a sum is the same in any order.
Rounding works on decimals and halves go away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE


def ratio(part: Column, whole: Column) -> Column:
    """part / whole with 14 decimals; null when whole is 0."""
    divisor = F.nullif(whole.cast("decimal(24,0)"), F.lit(0).cast("decimal(24,0)"))
    return part.cast("decimal(24,0)") / divisor


def rounded_ratio(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(part, whole), digits).cast("double")


def minutes(micros: Column) -> Column:
    """Microseconds as minutes with two decimals, wide enough for a whole fleet."""
    return F.round(ratio(micros, F.lit(MICROS_PER_MINUTE)), 2).cast("decimal(24,2)")
