"""Calendar spine."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def machine_day_grid(
    machines: DataFrame, first_day: datetime.date, last_day: datetime.date
) -> DataFrame:
    """One row per machine and day, both ends included.

    Each machine row generates its own days, so no join is involved.
    """
    days = F.sequence(F.lit(first_day), F.lit(last_day), F.expr("interval 1 day"))
    return machines.select("machine_id", F.explode(days).alias("day"))
