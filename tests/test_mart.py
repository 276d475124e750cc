import datetime
import uuid

import micro
import pytest
from pyspark.sql import functions as F

from linetally.operators.line_day import line_day_kpi, machine_day_parts, machine_time_daily
from linetally.plans import mart
from linetally.plans.mart import (
    build_line_day_kpi,
    days_to_rebuild,
    move_view,
    publish_line_day_kpi,
    read_line_day_kpi,
    read_machine_parts,
    read_machine_time,
    refresh_line_day_kpi,
    refresh_machine_time,
    write_line_day_kpi,
    write_machine_time,
)
from linetally.session import shared_folder
from linetally.sources import files, fixtures, schemas, snapshots
from linetally.sources.tables import read_table, save_table


@pytest.fixture
def path(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def rows(df):
    return sorted(tuple(r) for r in df.select(*schemas.LINE_DAY_KPI.schema.names).fillna(-1.0).collect())


def kpi(events, machines, runs):
    return line_day_kpi(machine_time_daily(events), machines, runs)


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_written_mart_reads_back(spark, sf_dir, path):
    whole = line_day_kpi(
        machine_time_daily(fixtures.machine_events(spark, sf_dir)),
        fixtures.machines(spark, sf_dir),
        fixtures.production_runs(spark, sf_dir),
    )
    write_line_day_kpi(whole, path)
    write_line_day_kpi(whole, path)
    stored = read_line_day_kpi(spark, path)
    assert stored.schema.simpleString() == schemas.LINE_DAY_KPI.schema.simpleString()
    assert rows(stored) == rows(whole)
    assert stored.groupBy("line_id", "day").count().where("count > 1").count() == 0


def test_publishing_switches_when_complete(spark, make, path):
    events, machines = make(schemas.EVENTS, micro.EVENTS), make(schemas.MACHINES, micro.MACHINES)
    runs = make(schemas.RUNS, micro.RUNS)
    first = kpi(events, machines, runs.limit(1))
    publish_line_day_kpi(first, "published", path)
    before = spark.table("published")
    assert rows(before) == rows(first)
    assert before.schema.simpleString() == schemas.LINE_DAY_KPI.schema.simpleString()
    broken = first.withColumn("good_qty", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        publish_line_day_kpi(broken, "published", path)
    assert rows(spark.table("published")) == rows(first)
    publish_line_day_kpi(kpi(events, machines, runs), "published", path)
    assert rows(spark.table("published")) == rows(kpi(events, machines, runs))
    assert rows(before) == rows(first)  # a reader that started earlier keeps its files


def test_day_filter_reads_only_its_folders(spark, sf_dir, path):
    whole = line_day_kpi(
        machine_time_daily(fixtures.machine_events(spark, sf_dir)),
        fixtures.machines(spark, sf_dir),
        fixtures.production_runs(spark, sf_dir),
    )
    write_line_day_kpi(whole, path)
    recent = read_line_day_kpi(spark, path).where(F.col("day") >= F.lit(datetime.date(2024, 2, 10)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert recent.count() > 0
    assert all("/day=2024-02-1" in name for name in files_of(recent))


def days(*numbers):
    return [datetime.date(2024, 1, n) for n in numbers]


def test_days_to_rebuild_reach_back_to_the_last_event_before(make):
    log = [
        (1, 1, "2024-01-01 10:00:00", "RUN", None, None),
        (2, 1, "2024-01-05 10:00:00", "RUN", None, None),
        (3, 1, "2024-01-20 10:00:00", "STOP", None, None),
        (4, 2, "2024-01-09 10:00:00", "RUN", None, None),  # nothing new: unchanged
        (5, 3, "2024-01-12 10:00:00", "RUN", None, None),
        (6, 3, "2024-01-25 10:00:00", "RUN", None, None),  # new after the range
        (7, 4, "2024-01-03 10:00:00", "RUN", None, None),  # what it had on the 21st is gone
    ]
    gone = (8, 4, "2024-01-21 10:00:00", "RUN", None, None)
    before, after = (machine_day_parts(make(schemas.EVENTS, rows)) for rows in ([*log[:2], *log[3:], gone], log))
    got = days_to_rebuild(before, after, *days(20, 21)).collect()
    assert sorted(r.day.day for r in got) == [3, 5, 20, 21]


def stored(path, events, machines, runs):
    build_line_day_kpi(path, events, machines, runs)


def test_refresh_equals_full_rebuild_after_late_events(spark, make, path):
    """Events arrive on days in the middle of the log, one of them long after its predecessor."""
    late = [
        (50, 3, "2024-01-05 03:00:00", "STOP", "PLAN", None),
        (51, 3, "2024-01-05 04:00:00", "RUN", None, None),
        (52, 2, "2024-01-06 00:00:00", "RUN", None, None),
    ]
    later = [
        (60, 1, "2024-01-10 00:00:00", "RUN", None, None),
        (61, 3, "2024-01-11 00:00:00", "RUN", None, None),
        # Jan 3 is not rebuilt, but ends the last interval of machine 1 on Jan 2, which is.
        (62, 1, "2024-01-03 05:00:00", "STOP", "MECH", None),
        (63, 1, "2024-01-03 06:00:00", "RUN", None, None),
    ]
    machines = make(schemas.MACHINES, micro.MACHINES)
    runs = make(schemas.RUNS, micro.RUNS)
    more_runs = make(schemas.RUNS, [*micro.RUNS, micro.run(6, 11, "2024-01-05 10:00:00", 70, 3)])
    before = make(schemas.EVENTS, micro.EVENTS + later)
    after = make(schemas.EVENTS, micro.EVENTS + later + late)

    stored(path, before, machines, runs)
    refresh_line_day_kpi(path, after, machines, more_runs, *days(5, 6))
    assert rows(read_line_day_kpi(spark, path)) == rows(kpi(after, machines, more_runs))
    assert rows(read_line_day_kpi(spark, path)) != rows(kpi(before, machines, runs))

    # And back again: the days lose all the rows they got.
    refresh_line_day_kpi(path, before, machines, runs, *days(5, 6))
    assert rows(read_line_day_kpi(spark, path)) == rows(kpi(before, machines, runs))
    left = read_machine_parts(spark, path).where(F.col("day").isin(*days(5, 6)))
    assert left.count() == 0


def test_refresh_of_days_within_the_log(spark, path):
    """Half of the events of a few days arrive late; all other days stay untouched files."""
    sf = "/root/testdata/sf0.001"
    events, machines = fixtures.machine_events(spark, sf), fixtures.machines(spark, sf)
    runs = fixtures.production_runs(spark, sf)
    first, last = days(10, 12)
    late = F.to_date("event_ts").between(first, last) & (F.col("event_id") % 2 == 0)
    stored(path, events.where(~late), machines, runs)
    old_files = files_of(read_machine_parts(spark, path).where(~F.col("day").between(first, last)))
    refresh_line_day_kpi(path, events, machines, runs, first, last)
    time, whole = read_machine_time(spark, path), machine_time_daily(events)
    assert time.exceptAll(whole.select(time.columns)).count() == 0 and time.count() == whole.count()
    assert rows(read_line_day_kpi(spark, path)) == rows(kpi(events, machines, runs))
    assert old_files == files_of(read_machine_parts(spark, path).where(~F.col("day").between(first, last)))


def test_refresh_reads_events_of_its_days_only(spark, make, path, monkeypatch):
    """Also where a machine that was silent for years comes back."""
    log = [(1, 1, "2020-01-01 10:00:00", "RUN", None, None), (2, 2, "2024-01-09 10:00:00", "RUN", None, None)]
    back = [(3, 1, "2024-01-10 10:00:00", "STOP", None, None)]
    machines, runs = make(schemas.MACHINES, micro.MACHINES), make(schemas.RUNS, micro.RUNS)
    stored(path, make(schemas.EVENTS, log), machines, runs)
    save_table(make(schemas.EVENTS, log + back), path + "-tables", schemas.EVENTS)
    events = read_table(spark, path + "-tables", schemas.EVENTS)
    seen = []
    original = mart.machine_day_parts
    monkeypatch.setattr(mart, "machine_day_parts", lambda given: seen.append(given) or original(given))
    refresh_line_day_kpi(path, events, machines, runs, *days(10, 10))
    assert [r.event_id for given in seen for r in given.collect()] == [3]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stored_day" in plan
    assert rows(read_line_day_kpi(spark, path)) == rows(kpi(events, machines, runs))


def test_old_versions_stay_for_a_while(spark, make, path):
    events, machines = make(schemas.EVENTS, micro.EVENTS), make(schemas.MACHINES, micro.MACHINES)
    mart_rows = kpi(events, machines, make(schemas.RUNS, micro.RUNS))
    first = write_line_day_kpi(mart_rows, path)
    second = write_line_day_kpi(mart_rows, path)
    assert files.versions(spark, f"{path}/snapshots") == [first, second]
    third = write_line_day_kpi(mart_rows, path, grace_seconds=0)
    assert files.versions(spark, f"{path}/snapshots") == [third]
    broken = mart_rows.withColumn("good_qty", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        write_line_day_kpi(broken, path, grace_seconds=0)
    assert rows(read_line_day_kpi(spark, path)) == rows(mart_rows)
    with pytest.raises(FileNotFoundError):
        read_line_day_kpi(spark, f"{path}-never")


LATE = [
    (50, 3, "2024-01-05 03:00:00", "STOP", "PLAN", None),
    (51, 1, "2024-01-05 04:00:00", "RUN", None, None),
]


def data_files(path):
    from pathlib import Path

    return {str(p) for p in Path(path, "data").rglob("*.parquet")}


def test_a_refresh_that_stops_anywhere_can_be_made_again(spark, make, path, monkeypatch):
    """Every write of a refresh fails once; nothing is visible before all is done."""
    from pyspark.sql import DataFrameWriter

    machines, runs = make(schemas.MACHINES, micro.MACHINES), make(schemas.RUNS, micro.RUNS)
    more_runs = make(schemas.RUNS, [*micro.RUNS, micro.run(6, 11, "2024-01-05 10:00:00", 70, 3)])
    # What machine 2 had on the changed day goes: its day before has to be rebuilt all the same.
    gone = [(60, 2, "2024-01-05 01:00:00", "STOP", "MECH", None)]
    before, after = make(schemas.EVENTS, micro.EVENTS + gone), make(schemas.EVENTS, micro.EVENTS + LATE)
    stored(path, before, machines, runs)
    known = rows(read_line_day_kpi(spark, path))
    original, left, stopped = DataFrameWriter.parquet, [0], 0

    def write(self, *args, **kwargs):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("stopped")
        original(self, *args, **kwargs)

    for n in range(20):
        left[0] = n
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        try:
            refresh_line_day_kpi(path, after, machines, more_runs, *days(5, 5))
        except OSError:
            stopped += 1
            assert rows(read_line_day_kpi(spark, path)) == known
            continue
        finally:
            monkeypatch.undo()
        break
    assert stopped == 3  # machine time, mart, snapshot
    assert rows(read_line_day_kpi(spark, path)) == rows(kpi(after, machines, more_runs)) != known
    time, whole = read_machine_time(spark, path), machine_time_daily(after)
    assert time.exceptAll(whole.select(time.columns)).count() == 0 and time.count() == whole.count()


def test_a_refresh_writes_the_rebuilt_days_only(spark, path):
    sf = "/root/testdata/sf0.001"
    events, machines = fixtures.machine_events(spark, sf), fixtures.machines(spark, sf)
    runs = fixtures.production_runs(spark, sf)
    day = datetime.date(2024, 1, 10)
    late = (F.to_date("event_ts") == F.lit(day)) & (F.col("event_id") % 2 == 0)
    stored(path, events.where(~late), machines, runs)
    parts, base = read_machine_parts(spark, path), snapshots.current(spark, path)
    expected = {r.day for r in days_to_rebuild(parts, machine_day_parts(events), day, day).collect()}
    old = data_files(path)
    refresh_line_day_kpi(path, events, machines, runs, day, day)
    new = data_files(path) - old
    assert old < data_files(path)
    of_time = {name for name in new if schemas.MACHINE_TIME.name in name}
    assert {name.split("day=")[1][:10] for name in of_time} == {"2024-01-10"}
    written = {datetime.date.fromisoformat(name.split("day=")[1][:10]) for name in new - of_time}
    assert written == expected and len(expected) < len(base.of(schemas.LINE_DAY_KPI)) / 2
    taken_over = set(snapshots.current(spark, path).of(schemas.LINE_DAY_KPI)) & set(base.of(schemas.LINE_DAY_KPI))
    assert {f.day for f in taken_over} == {f.day for f in base.of(schemas.LINE_DAY_KPI)} - expected
    assert rows(read_line_day_kpi(spark, path)) == rows(kpi(events, machines, runs))


def test_a_view_follows_a_refresh_and_filters_by_day(spark, make, path):
    machines, runs = make(schemas.MACHINES, micro.MACHINES), make(schemas.RUNS, micro.RUNS)
    stored(path, make(schemas.EVENTS, micro.EVENTS), machines, runs)
    move_view(spark, "line_kpi", path)
    first = rows(spark.table("line_kpi"))
    after = make(schemas.EVENTS, micro.EVENTS + LATE)
    refresh_line_day_kpi(path, after, machines, runs, *days(5, 5))
    assert rows(spark.table("line_kpi")) == first
    move_view(spark, "line_kpi", path)
    assert rows(spark.table("line_kpi")) == rows(kpi(after, machines, runs))
    recent = spark.table("line_kpi").where("day = date'2024-01-05'")
    assert all("day=2024-01-05" in name for name in files_of(recent)) and recent.count() > 0
    write_line_day_kpi(kpi(after, machines, runs).limit(0), path)
    move_view(spark, "line_kpi", path)
    assert spark.table("line_kpi").count() == 0 == read_line_day_kpi(spark, path).count()


def test_a_second_writer_is_refused(spark, make, path):
    parts = machine_day_parts(make(schemas.EVENTS, micro.EVENTS))
    write_machine_time(parts, path)
    base = snapshots.current(spark, path)
    write_machine_time(parts, path)
    with pytest.raises(RuntimeError, match="changed meanwhile"):
        snapshots.publish(spark, path, base, base.folders)


def test_machine_time_alone_is_refreshed_in_one_step(spark, make, path):
    events, after = make(schemas.EVENTS, micro.EVENTS), make(schemas.EVENTS, micro.EVENTS + LATE)
    write_machine_time(machine_day_parts(events), path)
    reader = read_machine_time(spark, path)
    refresh_machine_time(path, after, *days(5, 5))
    time, whole = read_machine_time(spark, path), machine_time_daily(after)
    assert time.exceptAll(whole.select(time.columns)).count() == 0 and time.count() == whole.count()
    assert reader.count() == machine_time_daily(events).count()  # a reader that started earlier
    write_line_day_kpi(kpi(after, make(schemas.MACHINES, micro.MACHINES), make(schemas.RUNS, micro.RUNS)), path)
    with pytest.raises(ValueError, match="no longer fit"):
        refresh_machine_time(path, after, *days(5, 5))


def test_what_no_snapshot_needs_is_deleted(spark, make, path):
    machines, runs = make(schemas.MACHINES, micro.MACHINES), make(schemas.RUNS, micro.RUNS)
    stored(path, make(schemas.EVENTS, micro.EVENTS), machines, runs)
    refresh_line_day_kpi(path, make(schemas.EVENTS, micro.EVENTS + LATE), machines, runs, *days(5, 5))
    expected = rows(read_line_day_kpi(spark, path))
    snapshots.write_batch(machine_day_parts(make(schemas.EVENTS, micro.EVENTS)), schemas.MACHINE_TIME, path, "never")
    assert snapshots.remove_unused(spark, path) == []
    removed = snapshots.remove_unused(spark, path, grace_seconds=-1)
    assert "machine_time_daily/batch=never" in removed and len(removed) > 1
    assert rows(read_line_day_kpi(spark, path)) == expected
    in_use = {f"{path}/data/{f.folder}" for f in snapshots.current(spark, path).folders}
    assert {name.rsplit("/", 1)[0] for name in data_files(path)} == in_use
