"""Declared tables: columns, keys, references, value domains and defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

INT, LONG, TEXT = IntegerType(), LongType(), StringType()
TIME, DATE, FLAG = TimestampNTZType(), DateType(), BooleanType()
NUMBER, MINUTES, RATE = DecimalType(38, 18), DecimalType(12, 2), DoubleType()


@dataclass(frozen=True)
class Reference:
    """A child column whose non-null values must exist as a key of the parent."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    layout: tuple[str, ...] = ()
    """Columns the stored files are sorted by; their day (of the first) is a folder."""
    lookups: tuple[str, ...] = ()
    """Columns that single rows are looked up by: stored files have Bloom filters on them."""

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _columns(required: dict[str, DataType], optional: dict[str, DataType] | None = None) -> StructType:
    fields = [StructField(name, kind, False) for name, kind in required.items()]
    return StructType(fields + [StructField(name, kind, True) for name, kind in (optional or {}).items()])


PLANTS = Table("dim_plants", _columns({"plant_id": INT, "plant_name": TEXT}), ("plant_id",))

LINES = Table(
    "dim_lines",
    _columns({"line_id": INT, "plant_id": INT, "line_name": TEXT}),
    ("line_id",),
    (Reference("plant_id", "dim_plants", "plant_id"),),
)

MACHINES = Table(
    "dim_machines",
    _columns({"machine_id": INT, "line_id": INT, "machine_name": TEXT}),
    ("machine_id",),
    (Reference("line_id", "dim_lines", "line_id"),),
)

PRODUCTS = Table(
    "dim_products",
    _columns({"product_id": INT, "product_family": TEXT, "product_name": TEXT}),
    ("product_id",),
)

CUSTOMERS = Table(
    "dim_customers", _columns({"customer_id": INT, "customer_name": TEXT}), ("customer_id",)
)

REASONS = Table(
    "dim_reason_codes",
    _columns({"reason_code": TEXT, "reason_category": TEXT, "reason_desc": TEXT}),
    ("reason_code",),
)

RUNS = Table(
    "fct_production_runs",
    _columns(
        {
            "work_order_id": LONG,
            "line_id": INT,
            "product_id": INT,
            "planned_start_ts": TIME,
            "planned_end_ts": TIME,
            "actual_start_ts": TIME,
            "actual_end_ts": TIME,
            "good_qty": INT,
            "scrap_qty": INT,
            "uom": TEXT,
        }
    ),
    ("work_order_id",),
    (
        Reference("line_id", "dim_lines", "line_id"),
        Reference("product_id", "dim_products", "product_id"),
    ),
    defaults={"uom": "unit"},
    layout=("actual_end_ts", "work_order_id"),
    lookups=("work_order_id",),
)

EVENTS = Table(
    "fct_machine_events",
    _columns(
        {"event_id": LONG, "machine_id": INT, "event_ts": TIME, "state": TEXT},
        {"reason_code": TEXT, "work_order_id": LONG},
    ),
    ("event_id",),
    (
        Reference("machine_id", "dim_machines", "machine_id"),
        Reference("reason_code", "dim_reason_codes", "reason_code"),
        Reference("work_order_id", "fct_production_runs", "work_order_id"),
    ),
    domains={"state": ("RUN", "STOP")},
    layout=("event_ts", "event_id"),
    lookups=("event_id", "work_order_id"),
)

QC_RESULTS = Table(
    "fct_qc_results",
    _columns(
        {
            "qc_id": LONG,
            "work_order_id": LONG,
            "sample_ts": TIME,
            "test_type": TEXT,
            "value": NUMBER,
            "in_spec": FLAG,
        }
    ),
    ("qc_id",),
    (Reference("work_order_id", "fct_production_runs", "work_order_id"),),
    layout=("sample_ts", "qc_id"),
    lookups=("qc_id", "work_order_id"),
)

SHIPMENTS = Table(
    "fct_shipments",
    _columns(
        {
            "shipment_id": LONG,
            "customer_id": INT,
            "product_id": INT,
            "order_id": LONG,
            "requested_ship_date": DATE,
            "actual_ship_date": DATE,
            "shipped_qty": INT,
        }
    ),
    ("shipment_id",),
    (
        Reference("customer_id", "dim_customers", "customer_id"),
        Reference("product_id", "dim_products", "product_id"),
    ),
    layout=("requested_ship_date", "shipment_id"),
    lookups=("shipment_id", "order_id"),
)

TABLES = {
    table.name: table
    for table in (
        PLANTS,
        LINES,
        MACHINES,
        PRODUCTS,
        CUSTOMERS,
        REASONS,
        RUNS,
        EVENTS,
        QC_RESULTS,
        SHIPMENTS,
    )
}

MACHINE_TIME = Table(
    "machine_time_daily",
    _columns(
        {"machine_id": INT, "day": DATE, "run_us": LONG, "stop_us": LONG, "first_ts": TIME},
        {"reason_code": TEXT, "last_ts": TIME, "last_state": TEXT},
    ),
    ("machine_id", "day", "reason_code"),
    layout=("day", "machine_id", "reason_code"),
)

LINE_DAY_KPI = Table(
    "mart_daily_line_kpi",
    _columns(
        {
            "line_id": INT,
            "day": DATE,
            "runtime_min": MINUTES,
            "downtime_min": MINUTES,
            "good_qty": LONG,
            "scrap_qty": LONG,
        },
        {"yield": RATE, "throughput_per_hour": RATE},
    ),
    ("line_id", "day"),
    layout=("day", "line_id"),
)
