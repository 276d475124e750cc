"""Results do not depend on the session's time zone or timestamp type."""

import micro
import pytest

from linetally.operators.intervals import state_intervals
from linetally.operators.line_day import line_day_kpi, machine_time_daily
from linetally.sources import fixtures, schemas


@pytest.fixture(params=["America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_LTZ")
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")


def test_no_hour_is_lost_when_clocks_change(make, zone):
    events = make(
        schemas.EVENTS,
        [
            (1, 1, "2024-03-10 01:00:00", "RUN", None, None),
            (2, 1, "2024-03-10 03:00:00", "STOP", None, None),
        ],
    )
    machines = make(schemas.MACHINES, micro.MACHINES)
    got = {r.event_id: r.duration_us for r in state_intervals(events, machines, 1_000_000).collect()}
    assert got == {1: 7_200_000_000, 2: 0}


def test_mart_is_the_same_in_every_zone(spark, sf_dir, zone):
    def mart():
        return line_day_kpi(
            machine_time_daily(fixtures.machine_events(spark, sf_dir)),
            fixtures.machines(spark, sf_dir),
            fixtures.production_runs(spark, sf_dir),
        ).fillna(-1.0)

    here = sorted(tuple(r) for r in mart().collect())
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert here == sorted(tuple(r) for r in mart().collect())
