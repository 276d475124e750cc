import datetime
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linetally.operators.work_orders import assign_work_order
from linetally.sources import fixtures, schemas


def brute_force(events, machines, runs):
    line_of = {m.machine_id: m.line_id for m in machines.collect()}
    starts = defaultdict(list)
    for run in runs.collect():
        starts[run.line_id, run.actual_start_ts.date()].append(run.work_order_id)
    result = {}
    for event in events.collect():
        found = sorted(starts.get((line_of.get(event.machine_id), event.event_ts.date()), []))
        result[event.event_id] = found[event.event_id % len(found)] if found else None
    return result


def assigned(events, machines, runs, ids_per_slice):
    rows = assign_work_order(events, machines, runs, ids_per_slice).collect()
    assert len(rows) == len({r.event_id for r in rows})
    return {r.event_id: r.work_order_id for r in rows}


@pytest.mark.parametrize("ids_per_slice", [1_000_000, 50])
def test_matches_brute_force(spark, ids_per_slice):
    sf = "/root/testdata/sf0.001"
    tables = (
        fixtures.machine_events(spark, sf),
        fixtures.machines(spark, sf),
        fixtures.production_runs(spark, sf),
    )
    expected = brute_force(*tables)
    assert None in expected.values() and len(set(expected.values())) > 100
    assert assigned(*tables, ids_per_slice) == expected


@pytest.mark.parametrize("ids_per_slice", [1_000_000, 40])
def test_one_line_day_holds_nearly_everything(make, ids_per_slice):
    """A single hot machine and line-day: many events on few runs, and on very many runs."""
    start = datetime.datetime(2024, 1, 1, 6)
    events = make(
        schemas.EVENTS,
        [(i, 1, start + datetime.timedelta(seconds=i), "RUN", None, None) for i in range(400)]
        + [(400 + i, 2, start + datetime.timedelta(days=i), "RUN", None, None) for i in range(5)]
        + [(500, 77, start, "RUN", None, None)],
    )
    machines = make(schemas.MACHINES, [(1, 10, "a"), (2, 11, "b")])

    def runs(n, line):
        day = "2024-01-01 06:00:00"
        return [(1000 * line + 37 * i, line, 1, day, day, day, day, 1, 0, "unit") for i in range(n)]

    for few_or_many in (runs(2, 10) + runs(3, 11), runs(300, 10) + runs(1, 12)):
        table = make(schemas.RUNS, few_or_many)
        assert assigned(events, machines, table, ids_per_slice) == brute_force(events, machines, table)


def test_keeps_event_columns(spark, sf_dir):
    rows = assign_work_order(
        fixtures.machine_events(spark, sf_dir),
        fixtures.machines(spark, sf_dir),
        fixtures.production_runs(spark, sf_dir),
    )
    assert rows.columns == schemas.EVENTS.schema.names
    assert rows.where(F.col("work_order_id").isNotNull()).count() > 0
