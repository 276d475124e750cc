
from __future__ import annotations

import datetime
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))  # wherever this file is loaded from

from linetally import oracle
from linetally.functions import days_back
from linetally.functions.times import STORED_DAY
from linetally.operators import audits, calendar, intervals, line_day, ranges, work_orders
from linetally.plans import crosschecks, downtime, mart, production, quality, shipping, snapshot
from linetally.session import shared_folder
from linetally.sources import fixtures, loads, snapshots
from linetally.sources.fixtures import AS_OF
from linetally.sources.schemas import EVENTS, QC_RESULTS, RUNS, TABLES, Reference
from linetally.sources.tables import fill_defaults, look_up, read_table, reason_codes, save_by_order, save_table

try:  # the operators on training data are an optional part
    import corpus_pipeline
    from linetally.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]
HOUR_US = 3_600_000_000


def _plain(rows: DataFrame) -> DataFrame:
    """Decimals as double, so that both engines hand out the same types."""
    decimals = [name for name, kind in rows.dtypes if kind.startswith("decimal")]
    return rows.withColumns({name: F.col(name).cast("double") for name in decimals})


def _log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixtures.machine_events(spark, sf_dir), fixtures.machines(spark, sf_dir)


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (*_log(spark, sf_dir), fixtures.production_runs(spark, sf_dir))


def _time(spark: SparkSession, sf_dir: str, days: int | None = None) -> DataFrame:
    since = None if days is None else days_back(AS_OF, days)
    return line_day.machine_time_daily(fixtures.machine_events(spark, sf_dir), since)


def _time_facts(
    spark: SparkSession, sf_dir: str, days: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        _time(spark, sf_dir, days),
        fixtures.machines(spark, sf_dir),
        fixtures.production_runs(spark, sf_dir),
    )


def _kpi(spark: SparkSession, sf_dir: str, days: int | None = None) -> DataFrame:
    since = None if days is None else days_back(AS_OF, days)
    return line_day.line_day_kpi(*_time_facts(spark, sf_dir, days), since=since)


def _fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _stored_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh_path(spark, "line_day_kpi")
    mart.write_line_day_kpi(_kpi(spark, sf_dir), path)
    return mart.read_line_day_kpi(spark, path)


def _overwritten_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of half of the lines, replaced by the whole one at the same path."""
    path = _fresh_path(spark, "line_day_kpi")
    kpi = _kpi(spark, sf_dir)
    mart.write_line_day_kpi(kpi.where(F.col("line_id") < 12), path)
    mart.write_line_day_kpi(kpi, path)
    return mart.read_line_day_kpi(spark, path)


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """Store time and KPI as known before some days, with too many events on one, then refresh."""
    path = _fresh_path(spark, "mart")
    events, machines, runs = _facts(spark, sf_dir)
    first, last = datetime.date(2024, 1, 20), datetime.date(2024, 2, 29)
    start = F.lit(first).cast("timestamp_ntz")
    moved = events.where(F.col("event_ts") >= start).withColumn(
        "event_ts", F.lit(last).cast("timestamp_ntz")
    )
    known = events.where(F.col("event_ts") < start).unionByName(moved.where(F.col("event_id") % 3 == 0))
    mart.build_line_day_kpi(path, known, machines, runs.where(F.col("actual_end_ts") < start))
    mart.refresh_line_day_kpi(path, events, machines, runs, first, last)
    return path


def _refreshed_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.read_line_day_kpi(spark, _refreshed(spark, sf_dir))


def _refreshed_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.read_machine_time(spark, _refreshed(spark, sf_dir))


def _inserted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored event table after writing the stops and then inserting the runs."""
    root = _fresh_path(spark, "tables")
    events = fixtures.machine_events(spark, sf_dir)
    save_table(events.where(F.col("state") == "STOP"), root, EVENTS)
    save_table(events.where(F.col("state") != "STOP"), root, EVENTS, mode="append")
    return read_table(spark, root, EVENTS).drop("work_order_id", STORED_DAY)


def _events_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops, then the runs together with stops that are known, and that batch once more."""
    path = _fresh_path(spark, "loaded")
    events = fixtures.machine_events(spark, sf_dir)
    stops, runs = events.where(F.col("state") == "STOP"), events.where(F.col("state") != "STOP")
    batch = runs.unionByName(stops.where(F.col("event_id") % 4 == 0)).unionByName(runs.where(F.col("event_id") % 9 == 0))
    loads.load_rows(stops, EVENTS, path, "stops")
    for _ in range(2):
        loads.load_rows(batch, EVENTS, path, "runs")
    return snapshots.read_table(spark, path, EVENTS).drop("work_order_id", STORED_DAY)


def _loaded_with_faults(spark: SparkSession, sf_dir: str) -> str:
    """Events of which some break a rule each, and some come twice, loaded in two batches."""
    path = _fresh_path(spark, "loaded")
    tables = fixtures.all_tables(spark, sf_dir)
    fault = F.col("event_id") % 50
    machine = F.when(fault == 2, F.col("machine_id") + 1_000_000).when(fault != 3, F.col("machine_id"))
    faulty = tables[EVENTS.name].select(
        "event_id",
        machine.cast("int").alias("machine_id"),
        F.when(fault != 6, F.col("event_ts")).alias("event_ts"),
        F.when(fault == 1, "IDLE").otherwise(F.col("state")).alias("state"),
        F.when(fault.isin(1, 4), "NONE").otherwise(F.col("reason_code")).alias("reason_code"),
        "work_order_id",
    )
    changed = faulty.where(fault == 5).withColumn("state", F.lit("STOP")).withColumn("reason_code", F.lit("PLAN"))
    first = F.col("event_id") % 3 == 0
    loads.load_rows(faulty.where(first), EVENTS, path, "first", tables)
    rest = faulty.where(~first).unionByName(faulty.where(fault == 7)).unionByName(changed)
    loads.load_rows(rest, EVENTS, path, "second", tables)
    return path


def _loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _loaded_with_faults(spark, sf_dir)
    return snapshots.read_table(spark, path, EVENTS).drop("work_order_id", STORED_DAY)


def _rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = loads.read_rejects(spark, _loaded_with_faults(spark, sf_dir), EVENTS)
    return rejects.drop("work_order_id").withColumn("reasons", F.array_join("reasons", "; "))


def _pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten tables, and lineitem, whose order line numbers are known to repeat."""
    declared = audits.pk_violations(fixtures.all_tables(spark, sf_dir), TABLES.values())
    lineitem = fixtures.raw(spark, sf_dir, "lineitem")
    return declared.unionByName(
        audits.key_violations(lineitem, "lineitem", ("l_orderkey", "l_linenumber"))
    )


def _fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten references, with events linked to runs, and two whose parents are incomplete.

    Those are the linked events against runs without every fifth, and orders, whose customers
    mostly are no machine numbers.
    """
    tables = fixtures.all_tables(spark, sf_dir)
    linked = work_orders.assign_work_order(*_facts(spark, sf_dir))
    runs = tables[RUNS.name]
    fewer = {RUNS.name: runs.where(F.col("work_order_id") % 5 != 0)}
    order = Reference("work_order_id", RUNS.name, "work_order_id")
    customer = Reference("o_custkey", "dim_machines", "machine_id")
    return (
        audits.fk_orphans({**tables, EVENTS.name: linked}, TABLES.values())
        .unionByName(audits.orphans(linked, "linked events", [order], fewer))
        .unionByName(audits.orphans(fixtures.raw(spark, sf_dir, "orders"), "orders", [customer], tables))
    )


def _not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All required columns, and two of the event log that are not and do have nulls."""
    tables = fixtures.all_tables(spark, sf_dir)
    declared = audits.not_null_violations(tables, TABLES.values())
    linked = work_orders.assign_work_order(*_facts(spark, sf_dir))
    return declared.unionByName(audits.null_counts(linked, "linked events", ["reason_code", "work_order_id"]))


def _state_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log, and the raw event types, none of which is a state."""
    tables = {EVENTS.name: fixtures.machine_events(spark, sf_dir)}
    raw = fixtures.raw(spark, sf_dir, "events")
    return audits.state_domain_violations(tables, [EVENTS]).unionByName(
        audits.domain_violations(raw, "events", "event_type", ("RUN", "STOP"))
    )


def _uom_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as runs; those of status P come without a unit."""
    orders = fixtures.raw(spark, sf_dir, "orders")
    key, pending = F.col("o_orderkey").alias("work_order_id"), F.col("o_orderstatus") == "P"
    given = orders.where(~pending).select(key, F.lit("kg").alias("uom"))
    return fill_defaults(given, RUNS).unionByName(fill_defaults(orders.where(pending).select(key), RUNS))


def _best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(snapshot.throughput_rank(_kpi(spark, sf_dir, 30), AS_OF))


def _worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(snapshot.throughput_rank(_kpi(spark, sf_dir, 30), AS_OF, best=False))


def _runs_products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixtures.production_runs(spark, sf_dir), fixtures.products(spark, sf_dir)


def _qc_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    qc, runs = fixtures.qc_results(spark, sf_dir), fixtures.production_runs(spark, sf_dir)
    return quality.qc_line_day_tally(qc, runs, AS_OF)


def _qc_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QC fail rates from samples and runs that are stored by work order."""
    stored = []
    for table, rows in ((QC_RESULTS, fixtures.qc_results), (RUNS, fixtures.production_runs)):
        path = _fresh_path(spark, table.name)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        save_by_order(rows(spark, sf_dir), table, name, path, buckets=8)
        stored.append(spark.table(name))
    return quality.qc_fail_by_line_day(quality.qc_line_day_tally_by_order(*stored, AS_OF))


def _looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single events from the stored table, by their ids."""
    root = _fresh_path(spark, "tables")
    save_table(fixtures.machine_events(spark, sf_dir), root, EVENTS)
    rows = look_up(read_table(spark, root, EVENTS), "event_id", [0, 1, 512, 4097, 10**12])
    return rows.drop("work_order_id", STORED_DAY)


def entry(spark: SparkSession) -> DataFrame:
    """The daily line KPI at sf0.001."""
    return _plain(_kpi(spark, "/root/testdata/sf0.001"))


def _llm_queries() -> dict[str, Query]:
    if llm_queries is None:
        return {}
    return {**llm_queries.queries(), "pipeline": corpus_pipeline.run}


def _llm_oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return {}
    pipeline = corpus_pipeline.ORACLE_SQL
    return {**llm_queries.oracle_sql(), **({"pipeline": pipeline} if pipeline else {})}


def line_queries() -> dict[str, Query]:
    return {
        "machine_events": lambda s, d: fixtures.machine_events(s, d).drop("work_order_id"),
        "production_runs": fixtures.production_runs,
        "qc_results": lambda s, d: _plain(fixtures.qc_results(s, d)),
        "shipments": fixtures.shipments,
        "insert_machine_events": _inserted_events,
        "insert_events_by_key": _events_by_key,
        "load_accepted_events": _loaded_events,
        "load_rejected_events": _rejected_events,
        "look_up_events": _looked_up,
        "state_intervals": lambda s, d: intervals.state_intervals(*_log(s, d)),
        "state_intervals_hourly_pieces": lambda s, d: intervals.state_intervals(*_log(s, d), slice_us=HOUR_US),
        "state_intervals_by_range": lambda s, d: ranges.state_intervals_by_range(
            *_log(s, d), _fresh_path(s, "sorted-events")
        ),
        "numbered_events": lambda s, d: ranges.numbered(
            fixtures.machine_events(s, d).drop("work_order_id"),
            ["event_ts", "event_id"],
            _fresh_path(s, "numbered-events"),
            "seq",
        ),
        "machine_time_daily": _time,
        "machine_time_hourly_pieces": lambda s, d: line_day.machine_time_daily(
            fixtures.machine_events(s, d), slice_us=HOUR_US
        ),
        "line_time_daily": lambda s, d: line_day.line_time_daily(_time(s, d), fixtures.machines(s, d)),
        "line_output_daily": lambda s, d: line_day.line_output_daily(fixtures.production_runs(s, d)),
        "line_day_kpi": lambda s, d: _plain(_kpi(s, d)),
        "write_line_day_kpi": lambda s, d: _plain(_stored_kpi(s, d)),
        "overwrite_line_day_kpi": lambda s, d: _plain(_overwritten_kpi(s, d)),
        "refresh_line_day_kpi": lambda s, d: _plain(_refreshed_kpi(s, d)),
        "refresh_machine_time": _refreshed_time,
        "kpi_snapshot": lambda s, d: _plain(snapshot.kpi_snapshot(_kpi(s, d, 14), AS_OF)),
        "best_throughput_days": _best,
        "worst_throughput_days": _worst,
        "downtime_pareto": lambda s, d: _plain(
            downtime.downtime_pareto(_time(s, d, 30), reason_codes(s), AS_OF)
        ),
        "downtime_by_line_reason": lambda s, d: _plain(
            downtime.downtime_by_line_reason(
                _time(s, d, 30), fixtures.machines(s, d), reason_codes(s), AS_OF
            )
        ),
        "output_by_family_day": lambda s, d: production.output_by_family_day(*_runs_products(s, d), AS_OF),
        "line_product_mix": lambda s, d: production.line_product_mix(*_runs_products(s, d), AS_OF),
        "schedule_adherence": lambda s, d: production.schedule_adherence(
            fixtures.production_runs(s, d), AS_OF
        ),
        "qc_fail_by_test": lambda s, d: quality.qc_fail_by_test(fixtures.qc_results(s, d), AS_OF),
        "qc_fail_by_line_day": lambda s, d: quality.qc_fail_by_line_day(_qc_tally(s, d)),
        "qc_fail_by_line_day_stored_by_order": _qc_by_order,
        "qc_vs_yield": lambda s, d: quality.qc_vs_yield(_qc_tally(s, d), _kpi(s, d, 30)),
        "on_time_overall": lambda s, d: shipping.on_time_overall(fixtures.shipments(s, d), AS_OF),
        "on_time_by_customer": lambda s, d: shipping.on_time_by_customer(
            fixtures.shipments(s, d), fixtures.customers(s, d), AS_OF
        ),
        "pk_violations": _pk_violations,
        "fk_orphans": _fk_orphans,
        "not_null_violations": _not_null_violations,
        "state_domain_violations": _state_domain_violations,
        "uom_default": _uom_default,
        "machine_day_grid": lambda s, d: calendar.machine_day_grid(
            fixtures.machines(s, d), datetime.date(2024, 1, 1), AS_OF
        ),
        "assign_work_order": lambda s, d: work_orders.assign_work_order(*_facts(s, d)),
        "log_vs_output_check": lambda s, d: crosschecks.log_vs_output_check(*_time_facts(s, d)),
    }


def queries() -> dict[str, Query]:
    return {**line_queries(), **_llm_queries()}


def oracle_sql() -> dict[str, str]:
    return {**oracle.statements(), **_llm_oracle_sql()}
