"""The ten tables as views over the driver's test tables (rules in FIXTURES.md)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linetally.sources.tables import reason_codes

AS_OF = datetime.date(2024, 1, 30)

# Reason codes of stops, test types.
REASON_CYCLE = ("MECH", "ELEC", "CHNG", "MTRL", "QUAL", "PLAN")
TEST_TYPES = ("viscosity", "thickness", "adhesion")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    """values[index], null past the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _after(start: Column, amount: Column, unit: str) -> Column:
    return start + amount.cast("int") * F.expr(f"interval 1 {unit}")


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("plant_id"), F.col("r_name").alias("plant_name")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("line_id"),
        F.col("n_regionkey").alias("plant_id"),
        F.col("n_name").alias("line_name"),
    )


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return (
        raw(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select(
            user.cast("int").alias("machine_id"),
            (user % 25).cast("int").alias("line_id"),
            F.concat(F.lit("M-"), user.cast("string")).alias("machine_name"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_type").alias("product_family"),
        F.col("p_name").alias("product_name"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def machine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stopped = F.col("event_type") == "error"
    return raw(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("int").alias("machine_id"),
        F.col("ts").alias("event_ts"),
        F.when(stopped, "STOP").otherwise("RUN").alias("state"),
        F.when(stopped, _pick(REASON_CYCLE, F.col("event_id") % 7)).alias("reason_code"),
        F.lit(None).cast("bigint").alias("work_order_id"),
    )


def production_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, line = F.col("o_orderkey"), F.col("o_custkey") % 25
    first = key % 45
    # Every order is a run.  A run due on one of its line's idle days starts the day after,
    # which leaves line-days with machine events but no output.
    offset = F.when((line + first) % 7 == 0, first + 1).otherwise(first)
    idle = (line + F.col("day_offset")) % 11 == 0
    start = _after(
        _after(F.expr("timestamp_ntz'2024-01-01 06:00:00'"), F.col("day_offset"), "day"), key % 11, "hour"
    )
    end = F.col("planned_start_ts") + F.expr("interval 6 hour")
    return (
        raw(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", offset.alias("day_offset"))
        .withColumn("planned_start_ts", start)
        .select(
            key.alias("work_order_id"),
            line.cast("int").alias("line_id"),
            (key % 200).cast("int").alias("product_id"),
            "planned_start_ts",
            end.alias("planned_end_ts"),
            _after(F.col("planned_start_ts"), key % 31, "minute").alias("actual_start_ts"),
            _after(end, key % 61, "minute").alias("actual_end_ts"),
            F.when(idle, 0).otherwise(800 + (key * 7) % 401).cast("int").alias("good_qty"),
            F.when(idle, 0).otherwise(key % 81).cast("int").alias("scrap_qty"),
            F.lit("unit").alias("uom"),
        )
    )


def qc_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, k = F.col("work_order_id"), F.col("k")
    return (
        production_runs(spark, sf_dir)
        .select("work_order_id", "actual_start_ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
        .select(
            (order * 2 + k).alias("qc_id"),
            "work_order_id",
            _after(F.col("actual_start_ts"), (order * 37 + k * 101) % 301, "minute").alias("sample_ts"),
            _pick(TEST_TYPES, (order + k) % 3).alias("test_type"),
            ((order * 17 + k) % 100).cast("decimal(38,18)").alias("value"),
            ((order * 13 + k * 7) % 100 >= 12).alias("in_spec"),
        )
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    late = F.when((key * 7) % 100 < 22, 1 + key % 7).otherwise(0).cast("int")
    requested = F.date_add(F.lit(datetime.date(2023, 11, 15)), (key % 90).cast("int"))
    return raw(spark, sf_dir, "orders").select(
        key.alias("shipment_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        (key % 200).cast("int").alias("product_id"),
        key.alias("order_id"),
        requested.alias("requested_ship_date"),
        F.date_add(requested, late).alias("actual_ship_date"),
        (200 + key % 801).cast("int").alias("shipped_qty"),
    )


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "dim_plants": plants(spark, sf_dir),
        "dim_lines": lines(spark, sf_dir),
        "dim_machines": machines(spark, sf_dir),
        "dim_products": products(spark, sf_dir),
        "dim_customers": customers(spark, sf_dir),
        "dim_reason_codes": reason_codes(spark),
        "fct_production_runs": production_runs(spark, sf_dir),
        "fct_machine_events": machine_events(spark, sf_dir),
        "fct_qc_results": qc_results(spark, sf_dir),
        "fct_shipments": shipments(spark, sf_dir),
    }
