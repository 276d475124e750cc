"""Column helpers shared by all operators."""

from linetally.functions.numbers import minutes, ratio, rounded_ratio
from linetally.functions.times import (
    as_date,
    days_back,
    epoch_micros,
    micros_between,
    on_or_after,
    rows_since,
)

__all__ = [
    "as_date",
    "days_back",
    "epoch_micros",
    "micros_between",
    "minutes",
    "on_or_after",
    "ratio",
    "rounded_ratio",
    "rows_since",
]
