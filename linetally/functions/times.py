"""Zone-free time arithmetic on ``timestamp_ntz`` and ``date`` columns."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime.date | str | None

# The folder column of stored tables.
STORED_DAY = "stored_day"


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from start to end, as bigint.

    Dividing the interval keeps the session time zone out of it; casting to a
    zoned timestamp would lose an hour wherever daylight saving begins.
    """
    return F.call_function("div", end - start, F.expr("interval '0.000001' second"))


def epoch_micros(ts: Column) -> Column:
    return micros_between(F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)


def as_date(as_of: AsOf) -> Column:
    """The report date; today when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def days_back(as_of: AsOf, days: int) -> Column:
    """First day of a report that looks back the given number of days."""
    return F.date_sub(as_date(as_of), days)


def on_or_after(ts: str, first_day: Column) -> Column:
    """Timestamp filter in the form the Parquet reader can use on its statistics."""
    return F.col(ts) >= first_day.cast("timestamp_ntz")


def rows_since(rows: DataFrame, ts: str, first_day: Column) -> DataFrame:
    """Rows from that day on.  Stored tables are also filtered by folder."""
    recent = rows.where(on_or_after(ts, first_day))
    return recent.where(F.col(STORED_DAY) >= first_day) if STORED_DAY in rows.columns else recent
