import dataclasses
import datetime
import uuid

import compare
from pyspark.sql import functions as F

import __spark_entry__ as entry
from linetally import job
from linetally.operators.ranges import read_ordered
from linetally.plans.mart import build_line_day_kpi, read_line_day_kpi, read_machine_time
from linetally.plans.reports import all_reports
from linetally.session import shared_folder
from linetally.sources import files, fixtures, snapshots
from linetally.sources.loads import days_of, load_folder
from linetally.sources.schemas import EVENTS, QC_RESULTS, RUNS, TABLES
from linetally.sources.tables import load_tables, read_table, save_event_log, save_table

SF = "/root/testdata/sf0.001"


def check(spark, tables, written):
    """From stored tables, over the stored mart, to stored reports in their order."""
    mart = next(path for path in written if path.endswith("/mart"))
    tally = spark.read.parquet(next(path for path in written if path.endswith("tally")))
    time, kpi = read_machine_time(spark, mart), read_line_day_kpi(spark, mart)
    given = snapshots.load_tables if files.exists(spark, f"{tables}/snapshots") else load_tables
    reports = all_reports(given(spark, tables), time, kpi, tally, fixtures.AS_OF)
    con, oracle = compare.connect(SF), entry.oracle_sql()
    names = [path.rsplit("/", 1)[1] for path in written if "/reports/" in path]
    assert len(names) == 14
    for path in written:
        folder, name = path.rsplit("/", 2)[1:]
        if folder == "reports":
            stored = read_ordered(spark, path)
            compare.assert_same(entry._plain(stored.drop("place")), con, oracle[name])
            in_order = [tuple(r)[:-1] for r in stored.orderBy("place").collect()]
            report = reports[name].collect()
            assert in_order == [tuple(r) for r in report], name
        elif name == "mart":
            compare.assert_same(entry._plain(read_line_day_kpi(spark, path)), con, oracle["line_day_kpi"])
            compare.assert_same(read_machine_time(spark, path), con, oracle["machine_time_daily"])


def violations(spark, written):
    audits = {path.rsplit("/", 1)[1]: spark.read.parquet(path) for path in written if "/audits/" in path}
    assert set(audits) == {"pk_violations", "fk_orphans", "not_null_violations", "state_domain_violations"}
    return {name: rows.where("n > 0").count() for name, rows in audits.items()}


def test_stored_results_equal_the_oracle_after_build_and_refresh(spark):
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    tables, out = f"{root}/tables", f"{root}/out"
    views = fixtures.all_tables(spark, SF)
    for name, rows in views.items():
        save_table(rows, tables, TABLES[name])
    written = job.run(spark, tables, out, fixtures.AS_OF, assign=True)
    check(spark, tables, written)
    assert violations(spark, written)["not_null_violations"] == 0
    linked = read_table(spark, out, dataclasses.replace(EVENTS, name="assigned_events"))
    assert linked.where("work_order_id is not null").count() > 0

    # The same tables, of which three days come later, and one day had rows that go again.
    first, last = datetime.date(2024, 1, 14), datetime.date(2024, 1, 16)
    events, runs = views["fct_machine_events"], views["fct_production_runs"]
    new_events = F.to_date("event_ts").between(first, last)
    new_runs = F.to_date("actual_end_ts").between(first, last)
    save_table(events.where(~new_events), tables, EVENTS)
    save_table(runs.where(~new_runs), tables, RUNS)
    job.run(spark, tables, out, fixtures.AS_OF)
    save_table(events.where(new_events), tables, EVENTS, mode="append")
    save_table(runs.where(new_runs), tables, RUNS, mode="append")
    check(spark, tables, job.run(spark, tables, out, fixtures.AS_OF, (first, last)))


def test_job_reports_violations_and_reads_a_bucketed_log(spark, make):
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    views = fixtures.all_tables(spark, SF)
    nameless = F.when(F.col("event_id") % 100 == 0, F.lit(None)).otherwise(F.col("machine_id"))
    bad = views[EVENTS.name].withColumn("machine_id", nameless.cast("int"))
    for name, rows in views.items():
        save_table(rows, f"{root}/tables", TABLES[name])
    save_event_log(bad, "bad_log", f"{root}/bad_log", 4)
    written = job.run(spark, f"{root}/tables", f"{root}/out", event_log="bad_log")
    assert violations(spark, written)["not_null_violations"] == 1


def test_all_reports_share_one_date(spark, monkeypatch):
    root, dates = f"{shared_folder(spark)}/{uuid.uuid4().hex}", []
    for name, rows in fixtures.all_tables(spark, SF).items():
        save_table(rows, f"{root}/tables", TABLES[name])
    original = job.all_reports
    monkeypatch.setattr(job, "all_reports", lambda *a: dates.append(a[-1]) or original(*a))
    job.run(spark, f"{root}/tables", f"{root}/out")
    assert isinstance(dates[0], datetime.date)


def test_batches_are_loaded_and_reported(spark):
    """Two batches, the second given twice and with bad rows, make the tables of the oracle."""
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    views, day = fixtures.all_tables(spark, SF), F.expr("timestamp_ntz'2024-01-20 00:00:00'")
    late = {EVENTS.name: F.col("event_ts") >= day, RUNS.name: F.col("actual_end_ts") >= day}
    for name, rows in views.items():
        if name in late:
            rows.where(~late[name]).write.parquet(f"{root}/first/{name}")
            bad = rows.limit(50).withColumn(TABLES[name].key[0], F.lit(None).cast("bigint"))
            rows.where(late[name]).unionByName(bad).write.parquet(f"{root}/second/{name}")
        else:
            # Samples come with the last of the work orders they refer to.
            rows.write.parquet(f"{root}/{'second' if name == QC_RESULTS.name else 'first'}/{name}")
    out, tables = f"{root}/out", f"{root}/tables"
    load_folder(spark, f"{root}/first", tables, "first")
    first = snapshots.load_tables(spark, tables)
    build_line_day_kpi(f"{out}/mart", first[EVENTS.name], first["dim_machines"], first[RUNS.name])
    written = job.run(spark, tables, out, fixtures.AS_OF, load=(f"{root}/second", "second"), refresh_loaded=True)
    assert not any(load_folder(spark, f"{root}/second", tables, "second").values())
    assert days_of(spark, tables, "second", EVENTS, RUNS)[0] == datetime.date(2024, 1, 20)
    assert days_of(spark, tables, "second", TABLES["dim_lines"]) is None
    rejects = spark.read.parquet(f"{out}/rejects/{EVENTS.name}")
    assert rejects.count() == 50 and rejects.where("reasons[0] = 'null: event_id'").count() == 50
    check(spark, tables, [path for path in written if "/rejects/" not in path])
    assert {name: n for name, n in violations(spark, written).items() if n} == {}
