import datetime
from decimal import Decimal

import micro
import pytest
from pyspark.sql import functions as F

from linetally.operators.intervals import DAY_US, state_intervals
from linetally.operators.line_day import line_day_kpi, machine_time_daily
from linetally.plans import crosschecks, downtime, quality, shipping, snapshot
from linetally.sources import schemas
from linetally.sources.tables import reason_codes

AS_OF = "2024-01-30"
D1, D2, D3 = (datetime.date(2024, 1, day) for day in (1, 2, 3))

# Pieces of a day, and of an hour.
SLICINGS = [DAY_US, 3_600_000_000]


@pytest.fixture
def plant(make):
    """Machine time, machines and runs."""
    return (
        machine_time_daily(make(schemas.EVENTS, micro.EVENTS)),
        make(schemas.MACHINES, micro.MACHINES),
        make(schemas.RUNS, micro.RUNS),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("slice_us", SLICINGS)
def test_intervals(make, plant, slice_us):
    events, machines = make(schemas.EVENTS, micro.EVENTS), plant[1]
    got = {r.event_id: r for r in state_intervals(events, machines, slice_us).collect()}
    known = {e[0] for e in micro.EVENTS if e[1] != 9}
    assert {k: r.duration_us for k, r in got.items()} == {k: micro.DURATION_US[k] for k in known}
    assert got[4].day == D1 and got[0].day == D1
    assert got[6].next_ts is None and got[1].next_ts == datetime.datetime(2024, 1, 1, 10)
    assert {r.line_id for k, r in got.items() if r.machine_id == 3} == {11}


@pytest.mark.parametrize("slice_us", SLICINGS)
def test_line_day_kpi(make, plant, slice_us):
    time = machine_time_daily(make(schemas.EVENTS, micro.EVENTS), slice_us=slice_us)
    got = {(r.line_id, r.day): r for r in line_day_kpi(time, *plant[1:]).collect()}
    assert set(got) == {(10, D1), (10, D2), (10, D3), (11, D1), (11, D2)}

    def check(key, run, stop, good, scrap, rate, per_hour):
        r = got[key]
        assert (r.runtime_min, r.downtime_min) == (Decimal(run), Decimal(stop))
        assert (r.good_qty, r.scrap_qty) == (good, scrap)
        assert r["yield"] == rate and r.throughput_per_hour == per_hour

    check((10, D1), "2190.00", "30.00", 1090, 110, 1090 / 1200, pytest.approx(29.8630364254, abs=1e-9))
    check((10, D2), "0.00", "60.00", 0, 0, None, None)
    check((10, D3), "0.00", "0.00", 500, 0, 1.0, None)
    check((11, D1), "1080.00", "0.00", 0, 7, 0.0, 0.0)
    check((11, D2), "0.00", "30.00", 0, 0, None, None)


def test_kpi_since_keeps_later_days_unchanged(make, plant):
    full = {(r.line_id, r.day): r for r in line_day_kpi(*plant).collect()}
    expected = {k: v for k, v in full.items() if k[1] >= D2}
    pruned = machine_time_daily(make(schemas.EVENTS, micro.EVENTS), F.lit(D2))
    for time in (plant[0], pruned):
        rows = line_day_kpi(time, *plant[1:], since=F.lit(D2)).collect()
        assert {(r.line_id, r.day): r for r in rows} == expected


def test_rankings_and_snapshot(plant):
    mart = line_day_kpi(*plant).cache()
    worst = snapshot.throughput_rank(mart, AS_OF, best=False)
    assert [(r.line_id, r.throughput_per_hour) for r in worst.collect()][0] == (11, 0.0)
    best = snapshot.throughput_rank(mart, AS_OF, n=1)
    assert best.columns == [
        "day", "line_id", "throughput_per_hour", "runtime_min", "downtime_min",
        "good_qty", "scrap_qty", "yield",
    ]
    assert [r.line_id for r in best.collect()] == [10]
    newest_first = snapshot.kpi_snapshot(mart, datetime.date(2024, 1, 16)).collect()
    assert [(r.day, r.line_id) for r in newest_first] == [(D3, 10), (D2, 10), (D2, 11)]
    # The lower bound is inclusive and there is no upper bound.
    assert snapshot.kpi_snapshot(mart, datetime.date(2024, 1, 1), 0).count() == 5
    mart.unpersist()


@pytest.mark.parametrize("slice_us", SLICINGS)
def test_pareto(spark, make, slice_us):
    time = machine_time_daily(make(schemas.EVENTS, micro.EVENTS), slice_us=slice_us)
    got = rows(downtime.downtime_pareto(time, reason_codes(spark), AS_OF))
    assert got == [
        ("UNKNOWN", Decimal("60.00"), 0.4, 0.4),
        ("CHANGEOVER", Decimal("30.00"), 0.2, 1.0),
        ("MECH", Decimal("30.00"), 0.2, 1.0),
        ("QUALITY", Decimal("30.00"), 0.2, 1.0),
        ("ELEC", Decimal("0.00"), 0.0, 1.0),
    ]


def test_pareto_of_running_events_only(spark, make):
    time = machine_time_daily(make(schemas.EVENTS, [e for e in micro.EVENTS if e[3] == "RUN"]))
    got = rows(downtime.downtime_pareto(time, reason_codes(spark), AS_OF))
    assert got == [("UNKNOWN", Decimal("0.00"), None, None)]


def test_pareto_cuts_by_start_day_only(spark, plant):
    """From Jan 2 on: the stop of machine 1 and of machine 3; earlier starts are out."""
    got = rows(downtime.downtime_pareto(plant[0], reason_codes(spark), "2024-02-01"))
    assert [r[:2] for r in got] == [("UNKNOWN", Decimal("60.00")), ("CHANGEOVER", Decimal("30.00"))]


def test_downtime_by_line(spark, plant):
    time, machines, _ = plant
    got = rows(downtime.downtime_by_line_reason(time, machines, reason_codes(spark), AS_OF))
    assert got == [
        (10, "UNKNOWN", Decimal("60.00")),
        (10, "MECH", Decimal("30.00")),
        (10, "ELEC", Decimal("0.00")),
        (11, "CHANGEOVER", Decimal("30.00")),
        (11, "UNKNOWN", Decimal("0.00")),
    ]


def test_shipping(make):
    shipments = make(schemas.SHIPMENTS, micro.SHIPMENTS)
    customers = make(schemas.CUSTOMERS, micro.CUSTOMERS)
    assert rows(shipping.on_time_by_customer(shipments, customers, AS_OF)) == [
        ("B", 1, 0.0, 1.0),
        ("A", 3, 0.6667, 1.0),
    ]
    assert rows(shipping.on_time_overall(shipments, AS_OF)) == [(0.5, 4)]
    assert rows(shipping.on_time_overall(shipments, "2030-01-01")) == [(None, 0)]


def test_as_of_defaults_to_today(make):
    today = datetime.date.today()
    shipments = make(
        schemas.SHIPMENTS,
        [
            (1, 1, 1, 1, today - datetime.timedelta(days=10), today, 5),
            (2, 1, 1, 2, today - datetime.timedelta(days=90), today, 5),
        ],
    )
    assert rows(shipping.on_time_overall(shipments)) == [(0.0, 1)]


def test_quality_rounds_halves_up(make):
    """1 fail of 32 is 0.03125, shown as 0.0313; the line comes from the work order."""
    samples = [(i, 3, "2024-01-05 10:00:00", "viscosity", Decimal(1), i > 0) for i in range(32)]
    qc = make(schemas.QC_RESULTS, samples)
    runs = make(schemas.RUNS, micro.RUNS)
    assert rows(quality.qc_fail_by_test(qc, AS_OF)) == [("viscosity", 32, 1, 0.0313)]
    assert rows(quality.qc_fail_by_line_day(quality.qc_line_day_tally(qc, runs, AS_OF))) == [
        (10, datetime.date(2024, 1, 5), 32, 1, 0.0313)
    ]


def test_log_vs_output_classes(make, plant):
    time, machines, runs = plant
    assert rows(crosschecks.log_vs_output_check(time, machines, runs)) == [
        ("NO_EVENTS", 1),
        ("NO_OUTPUT", 1),
        ("OK", 3),
    ]
    more = runs.union(make(schemas.RUNS, [micro.run(9, 11, "2024-01-02 13:00:00", 3, 0)]))
    assert ("RUNTIME_ZERO_WITH_OUTPUT", 1) in rows(crosschecks.log_vs_output_check(time, machines, more))
