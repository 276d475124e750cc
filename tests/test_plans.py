"""The physical plans keep their shape."""

import re

import pytest

import __spark_entry__ as entry
from linetally.operators.intervals import state_intervals
from linetally.operators.line_day import line_day_kpi, line_output_daily, machine_time_daily
from linetally.operators.work_orders import assign_work_order
from linetally.plans import production, quality
from linetally.sources import fixtures


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_static_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(plan, keys):
    return len(re.findall(rf"Exchange hashpartitioning\({keys}, \d+\)", plan))


def time_facts(spark, sf_dir, **options):
    return (
        machine_time_daily(fixtures.machine_events(spark, sf_dir), **options),
        fixtures.machines(spark, sf_dir),
        fixtures.production_runs(spark, sf_dir),
    )


def event_scans(plan):
    return sum("FileScan" in line and "event_id" in line for line in plan.splitlines())


STORING = {name for name in entry.line_queries() if name.startswith(("write_", "overwrite_", "refresh_", "insert_"))}


@pytest.mark.parametrize("name", sorted(set(entry.line_queries()) - STORING))
def test_no_python_and_no_cross_join(spark, sf_dir, name, no_static_broadcast):
    plan = plan_of(entry.line_queries()[name](spark, sf_dir))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_mart_shuffles_events_once_and_joins_in_place(spark, sf_dir, no_static_broadcast):
    plan = plan_of(line_day_kpi(*time_facts(spark, sf_dir)))
    # Below the full join: a sort and the final aggregate, no exchange before them.
    join = plan[plan.index("FullOuter") :]
    left = join[: join.index("Exchange")]
    assert "Sort" in left and "HashAggregate" in left
    assert exchanges(plan, r"line_id#\d+, day#\d+") == 1
    assert exchanges(plan, r"line_id#\d+, _groupingexpression#\d+") == 1
    # The events move once, by machine and day; their sums move once more, by machine.
    assert event_scans(plan) == 1
    assert exchanges(plan, r"machine_id#\d+, day#\d+") == 1
    assert plan.count("Exchange") == 6  # these four, the machine list, its distinct
    assert "Broadcast" not in plan


@pytest.mark.parametrize("slice_us", [86_400_000_000, 60_000_000])
def test_intervals_meet_their_line_in_place(spark, sf_dir, no_static_broadcast, slice_us):
    events, machines = fixtures.machine_events(spark, sf_dir), fixtures.machines(spark, sf_dir)
    plan = plan_of(state_intervals(events, machines, slice_us))
    top = plan[: plan.index("Window")]
    assert "SortMergeJoin" in top and "Exchange" not in top
    assert event_scans(plan) == 1


def jobs_run(spark):
    return set(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))


@pytest.mark.parametrize("name", ["state_intervals", "machine_time_daily", "assign_work_order", "line_day_kpi"])
def test_building_a_query_starts_no_job(spark, sf_dir, name):
    """But for the one that reads a Parquet footer."""
    frames = {n: fixtures.raw(spark, sf_dir, n) for n in ("events", "orders", "nation")}
    original, fixtures.raw = fixtures.raw, lambda s, d, n: frames[n]
    spark.sparkContext.setJobGroup("building", name)
    try:
        entry.line_queries()[name](spark, sf_dir)
        assert not jobs_run(spark)
    finally:
        fixtures.raw = original
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def assigned(spark, sf_dir):
    tables = (fixtures.machine_events, fixtures.machines, fixtures.production_runs)
    return assign_work_order(*[f(spark, sf_dir) for f in tables])


def test_assigned_events_stay_where_small_sides_can_be_broadcast(spark, sf_dir):
    rows = assigned(spark, sf_dir)
    rows.collect()
    final = plan_of(rows).split("Initial Plan")[0]
    joins = [line for line in final.splitlines() if "Join" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
    assert event_scans(final) == 1


def test_assigned_events_meet_candidates_in_one_splittable_join(spark, sf_dir, no_static_broadcast):
    """Where nothing can be broadcast, a plain join that adaptive execution may split."""
    plan = plan_of(assigned(spark, sf_dir))
    assert event_scans(plan) == 1
    top = plan[: plan.index("SortMergeJoin") + 200]
    assert "LeftOuter" in top and "Aggregate" not in top and "Window" not in top


def test_samples_move_once(spark, sf_dir, no_static_broadcast):
    qc, runs = fixtures.qc_results(spark, sf_dir), fixtures.production_runs(spark, sf_dir)
    plan = plan_of(quality.qc_line_day_tally(qc, runs, fixtures.AS_OF))
    assert plan.count("Exchange") == 3  # samples, runs, the sums by line and day
    assert plan.count("HashAggregate") == 2  # both above the join
    assert plan.rindex("HashAggregate") < plan.index("SortMergeJoin")


def test_samples_stored_by_order_do_not_move(spark, sf_dir, no_static_broadcast):
    plan = plan_of(entry.line_queries()["qc_fail_by_line_day_stored_by_order"](spark, sf_dir))
    below = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in below and below.count("FileScan") == 2


def test_date_filters_reach_the_scans(spark, sf_dir, no_static_broadcast):
    pareto = plan_of(entry.line_queries()["downtime_pareto"](spark, sf_dir))
    scans = [line for line in pareto.splitlines() if "FileScan" in line]
    assert scans and all("GreaterThanOrEqual(ts,2023-12-31T00:00" in scan for scan in scans)


def test_product_join_moves_sums(spark, sf_dir, no_static_broadcast):
    plan = plan_of(
        production.line_product_mix(
            fixtures.production_runs(spark, sf_dir), fixtures.products(spark, sf_dir), fixtures.AS_OF
        )
    )
    join = plan.index("Join")
    assert plan.index("HashAggregate", join) < plan.index("o_custkey", join)


def test_scan_reads_needed_columns_only(spark, sf_dir):
    plan = plan_of(line_output_daily(fixtures.production_runs(spark, sf_dir)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_top_k_needs_no_full_sort(spark, sf_dir):
    plan = plan_of(entry.line_queries()["best_throughput_days"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan
