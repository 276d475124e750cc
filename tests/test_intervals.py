"""Intervals are the same however logs are cut into pieces."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linetally.operators.intervals import DAY_US, in_pieces, machine_intervals, piece_keys, state_intervals
from linetally.operators.line_day import closed_machine_time, machine_day_parts, machine_time_daily
from linetally.sources import fixtures, schemas

START = datetime.datetime(2024, 1, 1)


def brute_force(events):
    """duration and successor per event, straight from the definition."""
    logs = defaultdict(list)
    for event in events:
        logs[event[1]].append(event)
    result = {}
    for log in logs.values():
        log.sort(key=lambda e: (e[2], e[0]))
        for event, follower in zip(log, log[1:] + [None], strict=True):
            until = follower[2] if follower else None
            micros = (until - event[2]) // datetime.timedelta(microseconds=1) if until else 0
            result[event[0]] = (until, micros)
    return result


def random_log(seed):
    """Machine 1 holds a third and more, with a burst, ties and months of silence."""
    rng = random.Random(seed)
    times = [(1, START + datetime.timedelta(seconds=rng.random() * 5)) for _ in range(60)]
    times += [(1, START + datetime.timedelta(days=rng.randrange(200), hours=3)) for _ in range(60)]
    times += [(1, START + datetime.timedelta(days=40)) for _ in range(30)]
    times += [(1, datetime.datetime(1969, 12, 31, 23, 0) + datetime.timedelta(minutes=i)) for i in range(90)]
    times += [
        (rng.randrange(2, 40), START + datetime.timedelta(minutes=rng.randrange(100_000)))
        for _ in range(200)
    ]
    rng.shuffle(times)
    return [
        (i, machine, ts, rng.choice(["RUN", "STOP"]), None, None) for i, (machine, ts) in enumerate(times)
    ]


WIDTHS = [DAY_US, 3_600_000_000, 1_000_000, 1]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slice_us", WIDTHS)
def test_intervals_match_brute_force(make, seed, slice_us):
    log = random_log(seed)
    got = machine_intervals(make(schemas.EVENTS, log), slice_us)
    assert {r.event_id: (r.next_ts, r.duration_us) for r in got.collect()} == brute_force(log)


@pytest.mark.parametrize("slice_us", WIDTHS)
def test_machine_time_matches_brute_force(make, slice_us):
    log = random_log(4)
    expected = defaultdict(lambda: [0, 0])
    for event_id, (_, micros) in brute_force(log).items():
        _, machine, ts, state, reason, _ = log[event_id]
        expected[machine, ts.date(), reason][state == "STOP"] += micros
    got = machine_time_daily(make(schemas.EVENTS, log), slice_us=slice_us).collect()
    assert {(r.machine_id, r.day, r.reason_code): [r.run_us, r.stop_us] for r in got} == expected
    assert len(got) == len(expected)


def test_parts_depend_on_their_day_alone(make):
    log = random_log(5)
    events = make(schemas.EVENTS, log)
    day = F.col("event_ts") < F.lit(START + datetime.timedelta(days=1))
    parts = machine_day_parts(events)
    split = machine_day_parts(events.where(day)).unionByName(machine_day_parts(events.where(~day)))
    assert parts.exceptAll(split).count() == 0 and parts.count() == split.count()
    whole = closed_machine_time(parts)
    assert whole.exceptAll(closed_machine_time(split)).count() == 0


def test_pieces_follow_the_order_of_the_log(make):
    """Also before 1970, where epoch times are negative."""
    events = in_pieces(make(schemas.EVENTS, random_log(3)), 60_000_000)
    rows = sorted(events.where("machine_id = 1").collect(), key=lambda r: (r.event_ts, r.event_id))
    pieces = [(r.day, r["slice"]) for r in rows]
    assert pieces == sorted(pieces)
    assert all(a.event_ts.replace(second=0, microsecond=0) == b.event_ts.replace(second=0, microsecond=0) for a, b in zip(rows, rows[1:]) if a["slice"] == b["slice"])


def test_slices_divide_the_day():
    assert piece_keys() == ["machine_id", "day"]
    assert piece_keys(1_000_000) == ["machine_id", "day", "slice"]
    for width in (7, 2 * DAY_US):
        with pytest.raises(ValueError):
            piece_keys(width)


def test_hot_machine_spreads_over_pieces(spark, sf_dir):
    """A machine with half of all rows is worked on day by day, or hour by hour."""
    events = fixtures.machine_events(spark, sf_dir)
    machine = F.when(F.col("event_id") % 2 == 0, 0).otherwise(F.col("machine_id"))
    hot = events.withColumn("machine_id", machine.cast("int"))
    sizes = in_pieces(hot).where("machine_id = 0").groupBy(*piece_keys()).count()
    assert sizes.count() == 30 and sizes.agg(F.max("count")).first()[0] < 300
    hours = in_pieces(hot, 3_600_000_000).where("machine_id = 0").groupBy(*piece_keys(3_600_000_000)).count()
    assert hours.count() > 600


def test_durations_add_up(spark, sf_dir):
    """Per machine, durations sum to the time between its first and last event."""
    events, machines = fixtures.machine_events(spark, sf_dir), fixtures.machines(spark, sf_dir)
    sums = state_intervals(events, machines).groupBy("machine_id").agg(F.sum("duration_us").alias("us"))
    spans = events.groupBy("machine_id").agg(
        F.expr("(max(event_ts) - min(event_ts)) div interval '0.000001' second").alias("span")
    )
    assert sums.join(spans, "machine_id").where("us <> span").count() == 0
    assert sums.count() == spans.count()
