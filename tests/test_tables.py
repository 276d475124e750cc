import datetime
import uuid

import micro
import pytest
from pyspark.sql import functions as F

from linetally.functions import days_back
from linetally.functions.times import STORED_DAY
from linetally.operators.intervals import state_intervals
from linetally.operators.line_day import machine_time_daily
from linetally.plans import production, quality, shipping
from linetally.session import shared_folder
from linetally.sources import fixtures, schemas
from linetally.sources.schemas import TABLES
from linetally.sources.tables import load_tables, look_up, read_table, register_views, save_event_log, save_table


@pytest.fixture
def root(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def test_all_tables_round_trip(spark, root):
    views = fixtures.all_tables(spark, "/root/testdata/sf0.001")
    for name, rows in views.items():
        save_table(rows, root, TABLES[name])
    stored = load_tables(spark, root)
    for name, table in TABLES.items():
        declared = stored[name].drop(STORED_DAY)
        assert [f.dataType for f in declared.schema.fields] == [f.dataType for f in table.schema.fields]
        assert declared.exceptAll(views[name].select(table.schema.names)).count() == 0
        assert stored[name].count() == views[name].count() > 0


def test_append_inserts(spark, make, root):
    rows = make(schemas.EVENTS, micro.EVENTS)
    save_table(rows, root, schemas.EVENTS)
    save_table(rows, root, schemas.EVENTS, mode="append")
    assert read_table(spark, root, schemas.EVENTS).count() == 2 * len(micro.EVENTS)
    save_table(rows, root, schemas.EVENTS)
    assert read_table(spark, root, schemas.EVENTS).count() == len(micro.EVENTS)


def test_missing_unit_is_filled_on_write(spark, make, root):
    save_table(make(schemas.RUNS, micro.RUNS).drop("uom"), root, schemas.RUNS)
    assert {r.uom for r in read_table(spark, root, schemas.RUNS).collect()} == {"unit"}


def test_tables_answer_sql(spark, make):
    register_views({"dim_machines": make(schemas.MACHINES, micro.MACHINES)})
    per_line = spark.sql("select line_id, count(*) n from dim_machines group by line_id order by 1")
    assert [tuple(r) for r in per_line.collect()] == [(10, 2), (11, 1)]


def test_insert_without_an_optional_column(spark, make, root):
    rows = make(schemas.EVENTS, micro.EVENTS)
    save_table(rows.drop("work_order_id"), root, schemas.EVENTS)
    stored = read_table(spark, root, schemas.EVENTS)
    assert stored.where("work_order_id is null").count() == len(micro.EVENTS)
    with pytest.raises(Exception, match="state"):
        save_table(rows.drop("state"), root, schemas.EVENTS)


def test_reports_open_only_the_folders_of_their_window(spark, root):
    sf = "/root/testdata/sf0.001"
    views = fixtures.all_tables(spark, sf)
    for name, rows in views.items():
        save_table(rows, root, TABLES[name])
    stored = load_tables(spark, root)
    as_of = datetime.date(2024, 2, 5)
    reports = [
        production.schedule_adherence(stored["fct_production_runs"], as_of, 3),
        quality.qc_fail_by_test(stored["fct_qc_results"], as_of, 3),
        shipping.on_time_overall(stored["fct_shipments"], as_of, 3),
        machine_time_daily(stored["fct_machine_events"], days_back(as_of, 20)),
    ]
    for report in reports:
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(stored_day" in plan, plan
    whole = production.schedule_adherence(views["fct_production_runs"], as_of, 3)
    assert reports[0].exceptAll(whole).count() == 0 and reports[0].count() == whole.count() > 0


def test_bucketed_log_needs_no_shuffle(spark, root):
    sf = "/root/testdata/sf0.001"
    events, machines = fixtures.machine_events(spark, sf), fixtures.machines(spark, sf)
    for name, rows in fixtures.all_tables(spark, sf).items():
        save_table(rows, root, TABLES[name])
    save_event_log(events, "event_log", f"{root}/event_log", 4)
    stored = load_tables(spark, root, "event_log")["fct_machine_events"]
    assert stored.exceptAll(events).count() == 0 and stored.count() == events.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        intervals = state_intervals(stored, machines)
        plan = intervals._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    log_side = plan[plan.index("Window") : plan.index("event_log")]
    assert "Exchange" not in log_side
    assert intervals.exceptAll(state_intervals(events, machines)).count() == 0


def test_one_date_with_most_rows_spreads_over_files(spark, root):
    """Rebalancing splits a large day."""
    rows = fixtures.shipments(spark, "/root/testdata/sf0.1").repartition(16)
    rows = rows.withColumn("requested_ship_date", F.lit(datetime.date(2024, 1, 1)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        save_table(rows, root, schemas.SHIPMENTS)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = read_table(spark, root, schemas.SHIPMENTS)
    per_file = stored.groupBy(F.input_file_name().alias("file")).count().agg(F.max("count"), F.count("*"))
    largest, files = per_file.first()
    assert files >= 4 and largest < 2 * stored.count() / files


def test_declared_counts():
    tables = TABLES.values()
    assert len(tables) == 10
    assert sum(len(t.key) for t in tables) == 10
    assert sum(len(t.references) for t in tables) == 10
    assert sum(len(t.required) - len(t.key) for t in tables) == 33


def rows_read(df):
    """Rows of the row groups that the scan could not skip."""
    df.collect()
    (scan,) = [p for p in scans(df._jdf.queryExecution().executedPlan())]
    return scan.metrics().apply("numOutputRows").value()


def scans(plan):
    leaves = plan.collectLeaves()
    return [leaves.apply(i) for i in range(leaves.size())]


def test_a_lookup_by_id_reads_few_row_groups(spark, root):
    """Ids that lie all over a day's times, so that their bounds say nothing."""
    day = F.expr("timestamp_ntz'2024-01-05 00:00:00'") + F.expr("interval 1 second") * F.col("id").cast("int")
    rows = spark.range(80_000).select(
        (F.col("id") * 48_271 % 2_147_483_647).alias("event_id"),
        F.lit(1).alias("machine_id"),
        day.alias("event_ts"),
        F.lit("RUN").alias("state"),
        (F.col("id") * 16_807 % 2_147_483_647).alias("work_order_id"),
    )
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(1 << 17))
    hadoop.set("parquet.block.row.count.limit", "5000")
    try:
        save_table(rows, root, schemas.EVENTS)
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.block.row.count.limit")
    stored = read_table(spark, root, schemas.EVENTS)
    wanted = [r.event_id for r in rows.where("id in (7, 40000)").collect()]
    found = look_up(stored, "event_id", wanted)
    assert sorted(r.event_id for r in found.collect()) == sorted(wanted)
    assert rows_read(stored) == 80_000 and 2 <= rows_read(found) <= 20_000
    order = rows.where("id = 55555").first().work_order_id
    assert [r.work_order_id for r in look_up(stored, "work_order_id", [order]).collect()] == [order]
    assert rows_read(look_up(stored, "work_order_id", [order])) <= 15_000
    assert look_up(stored, "event_id", []).count() == 0 == look_up(stored, "event_id", [-5]).count()
