import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from linetally.operators import audits
from linetally.operators.calendar import machine_day_grid
from linetally.sources import schemas
from linetally.sources.schemas import TABLES
from linetally.sources.tables import fill_defaults

TS = "2024-01-01 00:00:00"


@pytest.fixture
def tables(make):
    """Two violations of every kind in the facts, clean dimensions."""
    rows = {
        "dim_plants": [(1, "p")],
        "dim_lines": [(10, 1, "l"), (11, 2, "no plant 2")],
        "dim_machines": [(1, 10, "m"), (1, 10, "again")],
        "dim_products": [(1, "f", "n")],
        "dim_customers": [(1, "c")],
        "dim_reason_codes": [("MECH", "MECH", "d")],
        "fct_production_runs": [
            (1, 10, 1, TS, TS, TS, TS, 1, 1, "unit"),
            (None, 10, 9, TS, TS, TS, TS, 1, None, "unit"),
        ],
        "fct_machine_events": [
            (1, 1, TS, "RUN", None, None),
            (1, 5, TS, "IDLE", "NOPE", 77),
            (2, 5, TS, None, "MECH", 1),
            (3, None, TS, "idle", None, None),
        ],
        "fct_qc_results": [(1, 1, TS, "viscosity", Decimal(1), True), (2, 8, None, "x", Decimal(1), None)],
        "fct_shipments": [(1, 1, 1, 1, "2024-01-01", "2024-01-01", 1)] * 3,
    }
    return {name: make(TABLES[name], rows[name], strict=False) for name in TABLES}


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_keys(tables):
    assert found(audits.pk_violations(tables, TABLES.values())) == [
        ("dim_machines", '{"machine_id":1}', 2),
        ("fct_machine_events", '{"event_id":1}', 2),
        ("fct_production_runs", '{"work_order_id":null}', 1),
        ("fct_shipments", '{"shipment_id":1}', 3),
    ]


def test_compound_key(spark):
    given = [("1", "a"), ("1", "a"), ("1", "b"), (None, "b"), ("NULL", "b"), ("NULL", "b"), ("a|b", "c"), ("a", "b|c")]
    rows = spark.createDataFrame([*given, given[-1], given[-2]], "x string, y string")
    assert found(audits.key_violations(rows, "t", ("x", "y"))) == [
        ("t", '{"x":"1","y":"a"}', 2),
        ("t", '{"x":"NULL","y":"b"}', 2),
        ("t", '{"x":"a","y":"b|c"}', 2),
        ("t", '{"x":"a|b","y":"c"}', 2),
        ("t", '{"x":null,"y":"b"}', 1),
    ]


def test_references_read_each_table_once(tables, spark, tmp_path):
    path = str(tmp_path / "events")
    tables["fct_machine_events"].write.parquet(path)
    events = spark.read.parquet(path)
    found_orphans = audits.orphans(events, "e", schemas.EVENTS.references, tables)
    plan = found_orphans._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1


def test_references(tables):
    counts = {r[:2]: r[2] for r in found(audits.fk_orphans(tables, TABLES.values()))}
    assert len(counts) == 10
    assert {k: n for k, n in counts.items() if n} == {
        ("dim_lines", "plant_id"): 1,
        ("fct_production_runs", "product_id"): 1,
        ("fct_machine_events", "machine_id"): 2,
        ("fct_machine_events", "reason_code"): 1,
        ("fct_machine_events", "work_order_id"): 1,
        ("fct_qc_results", "work_order_id"): 1,
    }


def test_required_columns(tables):
    counts = {r[:2]: r[2] for r in found(audits.not_null_violations(tables, TABLES.values()))}
    assert len(counts) == 33 + 10  # declared not null, and the keys
    assert {k: n for k, n in counts.items() if n} == {
        ("fct_production_runs", "work_order_id"): 1,
        ("fct_production_runs", "scrap_qty"): 1,
        ("fct_machine_events", "machine_id"): 1,
        ("fct_machine_events", "state"): 1,
        ("fct_qc_results", "sample_ts"): 1,
        ("fct_qc_results", "in_spec"): 1,
    }


def test_domain_lets_null_pass(tables):
    assert found(audits.state_domain_violations(tables, TABLES.values())) == [
        ("fct_machine_events", "state", "IDLE", 1),
        ("fct_machine_events", "state", "idle", 1),
    ]


def test_default_unit(spark):
    rows = spark.createDataFrame([(1, "kg"), (2, None)], "work_order_id long, uom string")
    filled = fill_defaults(rows, schemas.RUNS).orderBy("work_order_id")
    assert [r.uom for r in filled.collect()] == ["kg", None]  # a violation, not a default
    assert found(audits.null_counts(filled, "t", ["uom"])) == [("t", "uom", 1)]
    assert {r.uom for r in fill_defaults(rows.drop("uom"), schemas.RUNS).collect()} == {"unit"}


def test_grid_includes_both_ends(tables):
    first, last = datetime.date(2024, 2, 27), datetime.date(2024, 3, 2)
    grid = machine_day_grid(tables["dim_machines"].distinct().limit(1), first, last)
    assert [r.day for r in grid.orderBy("day").collect()] == [
        first + datetime.timedelta(days=i) for i in range(5)
    ]
    assert grid.where(F.col("day") == datetime.date(2024, 2, 29)).count() == 1
