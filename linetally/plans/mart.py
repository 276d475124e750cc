"""Storing the daily line KPI and the machine time under it, and keeping them up to date.

Both lie at one path as tables of one snapshot (``sources.snapshots``): they change together, in
one step, and days that a change does not touch are taken over as the files they are.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.functions import on_or_after, rows_since
from linetally.functions.times import STORED_DAY
from linetally.operators.line_day import closed_machine_time, line_day_kpi, machine_day_parts
from linetally.sources import files, snapshots
from linetally.sources.schemas import LINE_DAY_KPI, MACHINE_TIME, Table


def _replace(rows: DataFrame, table: Table, path: str, grace_seconds: float) -> str:
    spark = rows.sparkSession
    base = snapshots.current(spark, path)
    fresh = snapshots.write_batch(rows, table, path)
    return snapshots.publish(spark, path, base, [*base.others(table), *fresh], grace_seconds)


def write_line_day_kpi(mart: DataFrame, path: str, grace_seconds: float = files.GRACE_SECONDS) -> str:
    """Replace the mart stored at a path in one step; returns the place of its snapshot.

    The rows are stored by day, sorted by line within a day: a filter on ``day`` reads only its
    folders.  Readers keep the mart before until this one is complete, also if writing fails;
    what was replaced more than ``grace_seconds`` ago is deleted.
    """
    return _replace(mart, LINE_DAY_KPI, path, grace_seconds)


def read_line_day_kpi(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read_table(spark, path, LINE_DAY_KPI)


def publish_line_day_kpi(
    mart: DataFrame, name: str, path: str, grace_seconds: float = files.GRACE_SECONDS
) -> str:
    """Like ``write_line_day_kpi``, and move a view to the new mart."""
    version = write_line_day_kpi(mart, path, grace_seconds)
    move_view(mart.sparkSession, name, path)
    return version


def move_view(spark: SparkSession, name: str, path: str) -> None:
    """Let a view show the mart that is stored at a path now, also after a refresh."""
    columns = ", ".join(
        f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in LINE_DAY_KPI.schema.fields
    )
    days: dict[str, list[str]] = {}
    for folder in snapshots.existing(spark, path).of(LINE_DAY_KPI):
        days.setdefault(folder.batch, []).append("null" if folder.day is None else f"date'{folder.day}'")
    parts = [
        f"select {columns} from parquet.`{snapshots.batch_path(path, LINE_DAY_KPI, batch)}` "
        f"where day in ({', '.join(given)}){' or day is null' if 'null' in given else ''}"
        for batch, given in sorted(days.items())
    ]
    empty = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in LINE_DAY_KPI.schema.fields)
    body = " union all ".join(parts) or f"select {empty} where false"
    spark.sql(f"create or replace view {name} as {body}")


def write_machine_time(parts: DataFrame, path: str, grace_seconds: float = files.GRACE_SECONDS) -> str:
    """Store ``machine_day_parts`` by day, so that the log is shuffled once for all reports."""
    return _replace(parts, MACHINE_TIME, path, grace_seconds)


def read_machine_parts(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read_table(spark, path, MACHINE_TIME)


def read_machine_time(spark: SparkSession, path: str) -> DataFrame:
    """Machine time per machine, day and reason, its last intervals closed."""
    return closed_machine_time(read_machine_parts(spark, path))


def build_line_day_kpi(path: str, events: DataFrame, machines: DataFrame, runs: DataFrame) -> str:
    """Store machine time and mart of the whole log; both appear in one step."""
    spark = events.sparkSession
    base = snapshots.current(spark, path)
    time = snapshots.write_batch(machine_day_parts(events), MACHINE_TIME, path)
    parts = snapshots.read(spark, path, time, MACHINE_TIME.schema)
    kpi = line_day_kpi(closed_machine_time(parts), machines, runs)
    mart = snapshots.write_batch(kpi, LINE_DAY_KPI, path)
    return snapshots.publish(spark, path, base, [*base.others(MACHINE_TIME, LINE_DAY_KPI), *time, *mart])


def _in_days(ts: str, first_day: datetime.date, last_day: datetime.date) -> Column:
    after = F.lit(last_day + datetime.timedelta(days=1))
    return on_or_after(ts, F.lit(first_day)) & ~on_or_after(ts, after)


def _fresh_time(
    base: snapshots.Snapshot, path: str, events: DataFrame, first_day: datetime.date, last_day: datetime.date
) -> list[snapshots.Folder]:
    """The folders of machine time once the given days are what the log has for them now.

    Only events of these days are read, however long a machine was silent before: parts of
    other days do not depend on them.  A day that has no events any more has no folder.
    """
    changed = events.where(_in_days("event_ts", first_day, last_day))
    if STORED_DAY in events.columns:
        changed = changed.where(F.col(STORED_DAY).between(first_day, last_day))
    fresh = snapshots.write_batch(machine_day_parts(changed), MACHINE_TIME, path)
    kept = [f for f in base.of(MACHINE_TIME) if f.day is None or not first_day <= f.day <= last_day]
    return [*kept, *fresh]


def refresh_machine_time(
    path: str, events: DataFrame, first_day: datetime.date, last_day: datetime.date
) -> None:
    """Replace the stored days first_day..last_day by what the log has for them now, in one step.

    Where a mart is stored beside it, ``refresh_line_day_kpi`` refreshes both.
    """
    spark = events.sparkSession
    base = snapshots.existing(spark, path)
    if base.of(LINE_DAY_KPI):
        raise ValueError("the mart at this path would no longer fit; use refresh_line_day_kpi")
    time = _fresh_time(base, path, events, first_day, last_day)
    snapshots.publish(spark, path, base, [*base.others(MACHINE_TIME), *time])


def days_to_rebuild(
    before: DataFrame, after: DataFrame, first_day: datetime.date, last_day: datetime.date
) -> DataFrame:
    """The days whose KPI can change when events or runs of first_day..last_day change.

    Besides these days themselves that is, for every machine that has or had events on them, the
    day of its last event before: that interval ends anew.  ``before`` and ``after`` are
    the machine parts around the change.
    """
    inside = F.col("day").between(first_day, last_day)
    changed = before.where(inside).select("machine_id").union(after.where(inside).select("machine_id")).distinct()
    last_seen = after.where(F.col("day") < F.lit(first_day)).groupBy("machine_id").agg(F.max("day").alias("day"))
    given = after.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first_day), F.lit(last_day), F.expr("interval 1 day"))).alias("day")
    )
    earlier = last_seen.join(changed, "machine_id", "left_semi").select("day")
    return earlier.union(given).distinct()


def refresh_line_day_kpi(
    path: str,
    events: DataFrame,
    machines: DataFrame,
    runs: DataFrame,
    first_day: datetime.date,
    last_day: datetime.date,
) -> None:
    """Bring stored machine time and mart up to date after changes on first_day..last_day.

    Of the log only these days are read.  Line-days of other days are recomputed from the stored
    machine parts where an interval into the changed days ends anew; all others are taken over as the
    files they are.  Nothing that is stored changes until both appear in one step, so that a
    refresh that failed, wherever it did, is simply made again.

    The list of days is collected and broadcast; it is no longer than the calendar.
    """
    spark = events.sparkSession
    base = snapshots.existing(spark, path)
    before = snapshots.read_table(spark, path, MACHINE_TIME, base)
    time_folders = _fresh_time(base, path, events, first_day, last_day)
    parts = snapshots.read(spark, path, time_folders, MACHINE_TIME.schema)
    rebuilt = sorted(row.day for row in days_to_rebuild(before, parts, first_day, last_day).collect())
    days = F.broadcast(spark.createDataFrame([(day,) for day in rebuilt], "day date"))
    first = F.lit(rebuilt[0])
    time = closed_machine_time(parts.where(F.col("day") >= first)).join(days, "day", "left_semi")
    ended = rows_since(runs, "actual_end_ts", first).withColumn("day", F.to_date("actual_end_ts"))
    fresh = line_day_kpi(time, machines, ended.join(days, "day", "left_semi").drop("day"))
    fresh_folders = snapshots.write_batch(fresh, LINE_DAY_KPI, path)
    kept = [f for f in base.of(LINE_DAY_KPI) if f.day not in set(rebuilt)]
    others = base.others(MACHINE_TIME, LINE_DAY_KPI)
    snapshots.publish(spark, path, base, [*others, *time_folders, *kept, *fresh_folders])
