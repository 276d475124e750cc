import uuid

import pytest
from pyspark.sql import functions as F
from test_intervals import brute_force, random_log

from linetally.operators.ranges import numbered, read_ordered, state_intervals_by_range, store_ordered, with_successors
from linetally.session import shared_folder
from linetally.sources import fixtures, schemas


@pytest.fixture
def path(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@pytest.fixture
def many_ranges(spark):
    """As many ranges as rows allow, of any size."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("n", [1, 7, 60])
def test_successors_match_brute_force(make, path, many_ranges, n):
    many_ranges(n)
    log = random_log(n)
    got = with_successors(make(schemas.EVENTS, log), path).collect()
    assert {r.event_id: r.next_ts for r in got} == {k: v[0] for k, v in brute_force(log).items()}
    assert len(got) == len(log)


def test_successors_of_nulls_and_of_nothing(spark, make, path):
    log = [
        (1, None, "2024-01-01 10:00:00", "RUN", None, None),
        (2, None, "2024-01-01 09:00:00", "RUN", None, None),
        (3, 1, None, "RUN", None, None),
        (4, 1, "2024-01-01 09:00:00", "RUN", None, None),
    ]
    events = make(schemas.EVENTS, log, strict=False)
    found = {r.event_id: str(r.next_ts) for r in with_successors(events, path).collect()}
    assert found == {1: "None", 2: "2024-01-01 10:00:00", 3: "2024-01-01 09:00:00", 4: "None"}
    assert with_successors(events.limit(0), path).count() == 0


def test_one_machine_with_all_events_in_a_day_spreads_over_all_tasks(spark, sf_dir, path, many_ranges):
    many_ranges(16)
    day = F.expr("timestamp_ntz'2024-01-05 00:00:00'") + F.expr("interval 1 second") * (F.col("event_id") % 80_000).cast("int")
    hot = fixtures.machine_events(spark, sf_dir).withColumns({"machine_id": F.lit(1), "event_ts": day})
    got = state_intervals_by_range(hot, spark.createDataFrame([(1, 5)], "machine_id int, line_id int"), path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("range_id").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16
    span = hot.agg(F.expr("(max(event_ts) - min(event_ts)) div interval '0.000001' second")).first()[0]
    assert got.agg(F.sum("duration_us")).first()[0] == span and got.count() == hot.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning(machine_id" in line]
    assert len(keys) == 2  # machines of the ranges, and the dimension; no events
    assert sum("Exchange hashpartitioning(range_id" in line for line in plan.splitlines()) >= 2


def test_numbers_have_no_gaps_and_do_not_change(spark, sf_dir, path, many_ranges):
    many_ranges(13)
    events = fixtures.machine_events(spark, sf_dir)
    rows = numbered(events, ["event_ts", "event_id"], path, "n")
    got = sorted(rows.collect(), key=lambda r: (r.event_ts, r.event_id))
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    assert rows.exceptAll(read_ordered(spark, path, "n")).count() == 0
    assert numbered(events.limit(0), ["event_ts"], path).count() == 0


def test_a_stored_report_reads_back_in_its_order(spark, path):
    report = spark.range(500).selectExpr("id", "id * 7919 % 101 as score").orderBy(F.desc("score"), "id")
    store_ordered(report, path)
    assert [r.id for r in read_ordered(spark, path).orderBy("place").collect()] == [r.id for r in report.collect()]
    store_ordered(report.limit(15), path)
    back = read_ordered(spark, path).orderBy("place").collect()
    assert [r.id for r in back] == [r.id for r in report.limit(15).collect()] and back[-1].place == 15
