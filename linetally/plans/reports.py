"""All reports over one set of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linetally.functions.times import AsOf
from linetally.plans import crosschecks, downtime, production, quality, shipping, snapshot


def all_reports(
    tables: dict[str, DataFrame],
    machine_time: DataFrame,
    mart: DataFrame,
    qc_tally: DataFrame,
    as_of: AsOf = None,
) -> dict[str, DataFrame]:
    """Report name to DataFrame, from the tables and the stored results they share."""
    runs, qc, shipments = (
        tables[name] for name in ("fct_production_runs", "fct_qc_results", "fct_shipments")
    )
    machines, products = tables["dim_machines"], tables["dim_products"]
    reasons, customers = tables["dim_reason_codes"], tables["dim_customers"]
    return {
        "kpi_snapshot": snapshot.kpi_snapshot(mart, as_of),
        "best_throughput_days": snapshot.throughput_rank(mart, as_of),
        "worst_throughput_days": snapshot.throughput_rank(mart, as_of, best=False),
        "downtime_pareto": downtime.downtime_pareto(machine_time, reasons, as_of),
        "downtime_by_line_reason": downtime.downtime_by_line_reason(
            machine_time, machines, reasons, as_of
        ),
        "output_by_family_day": production.output_by_family_day(runs, products, as_of),
        "line_product_mix": production.line_product_mix(runs, products, as_of),
        "schedule_adherence": production.schedule_adherence(runs, as_of),
        "qc_fail_by_test": quality.qc_fail_by_test(qc, as_of),
        "qc_fail_by_line_day": quality.qc_fail_by_line_day(qc_tally),
        "qc_vs_yield": quality.qc_vs_yield(qc_tally, mart),
        "on_time_overall": shipping.on_time_overall(shipments, as_of),
        "on_time_by_customer": shipping.on_time_by_customer(shipments, customers, as_of),
        "log_vs_output_check": crosschecks.log_vs_output_check(machine_time, machines, runs),
    }
