"""State-change events to state intervals.

An event holds until the next event of the same machine, whatever its state.  The last
event of a machine lasts 0.  An interval belongs to the day on which it starts.

A log is worked on in pieces, one per machine and day.  Within a piece a window finds each
event's successor; across pieces a table with one row per piece carries the first event of
the machine's next piece.  However long a machine's log is, no task needs more than a day of
it, and the plan is the same for all sizes.  Where single days are too long, ``slice_us``
makes the pieces shorter; the result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetally.functions import epoch_micros, micros_between

DAY_US = 86_400_000_000
DAY_PIECE = ["machine_id", "day"]


def piece_keys(slice_us: int = DAY_US) -> list[str]:
    """The columns that name a piece of a log, in its order within a machine."""
    if slice_us > DAY_US or DAY_US % slice_us:
        raise ValueError("a slice must divide the day")
    return DAY_PIECE if slice_us == DAY_US else [*DAY_PIECE, "slice"]


def in_pieces(events: DataFrame, slice_us: int = DAY_US) -> DataFrame:
    """Events with the columns that name their piece."""
    rows = events.withColumn("day", F.to_date("event_ts"))
    if piece_keys(slice_us) == DAY_PIECE:
        return rows
    width, micros = F.lit(slice_us).cast("bigint"), epoch_micros(F.col("event_ts"))
    return rows.withColumn("slice", F.call_function("div", micros - F.pmod(micros, width), width))


def piece_ends(events: DataFrame, slice_us: int = DAY_US) -> DataFrame:
    """For each piece, when the machine's first event after it happens (``seam_ts``).

    First events combine map-side, so a task sends one row per piece.  The rows stay
    partitioned by machine.
    """
    keys = piece_keys(slice_us)
    in_order = Window.partitionBy("machine_id").orderBy(*keys[1:])
    first = in_pieces(events, slice_us).groupBy(*keys).agg(F.min("event_ts").alias("first_ts"))
    return first.select(*keys, F.lead("first_ts").over(in_order).alias("seam_ts"))


def with_successor(events: DataFrame, slice_us: int = DAY_US) -> DataFrame:
    """Events with ``next_ts``, the time of the machine's next event within the piece, or null."""
    in_order = Window.partitionBy(*piece_keys(slice_us)).orderBy("event_ts", "event_id")
    return in_pieces(events, slice_us).withColumn("next_ts", F.lead("event_ts").over(in_order))


def duration_us() -> Column:
    """Microseconds from event_ts to next_ts, 0 without it."""
    until = F.coalesce("next_ts", "event_ts")
    return F.greatest(micros_between(F.col("event_ts"), until), F.lit(0))


def _with_durations(events: DataFrame, pieces: DataFrame, how: str, slice_us: int) -> DataFrame:
    return (
        with_successor(events, slice_us)
        .join(pieces, piece_keys(slice_us), how)
        .withColumn("next_ts", F.coalesce("next_ts", "seam_ts"))
        .withColumn("duration_us", duration_us())
        .drop("seam_ts")
    )


def machine_intervals(events: DataFrame, slice_us: int = DAY_US) -> DataFrame:
    """Events with next_ts, duration_us and day.

    The rows are hash-partitioned by their piece: aggregates keyed by machine, day and any
    other columns run without another shuffle.
    """
    return _with_durations(events, piece_ends(events, slice_us), "left", slice_us)


def state_intervals(events: DataFrame, machines: DataFrame, slice_us: int = DAY_US) -> DataFrame:
    """One row per event of a known machine, with its line, day and duration in microseconds.

    The line joins the pieces, which are partitioned by machine already, and comes to the
    events with the seams: the events are shuffled once however large the dimension is.
    """
    lines = machines.select("machine_id", "line_id")
    pieces = piece_ends(events, slice_us).join(lines, "machine_id")
    return _with_durations(events, pieces, "inner", slice_us).select(
        "event_id",
        "machine_id",
        "line_id",
        "day",
        "state",
        "reason_code",
        "event_ts",
        "next_ts",
        "duration_us",
    )


def time_in(state: str) -> Column:
    """Sum of the microseconds spent in a state; 0 where it does not occur."""
    return F.sum(F.when(F.col("state") == state, F.col("duration_us")).otherwise(0))
