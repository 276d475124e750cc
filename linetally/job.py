"""Builds the mart from stored tables and writes every report and audit.

spark-submit --py-files linetally.zip linetally/job.py --tables ROOT --out FOLDER
             [--as-of YYYY-MM-DD] [--refresh FIRST LAST] [--event-log NAME] [--assign]
             [--load FOLDER BATCH [--refresh-loaded]]

ROOT holds one Parquet folder per table, or a snapshot of all of them (sources.snapshots).  --load adds a batch of
rows to that snapshot first, from a Parquet folder per table, and writes what it rejected to rejects/<table>;
the same batch is not added twice.  --refresh-loaded then refreshes the days that the batch has events or runs of.  FOLDER receives mart (machine time and daily KPI, see
plans.mart), qc_line_day_tally, reports/<name> and audits/<name>; both must be
reachable from every executor.  The event log is shuffled once.  With --refresh the stored
machine time and mart are only brought up to date for rows changed on the days FIRST to LAST.
--event-log names a bucketed catalog table to read events from.  --assign links events to work
orders first, stores them as assigned_events, and audits that link.
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from linetally.operators.audits import all_audits
from linetally.operators.ranges import store_ordered
from linetally.operators.work_orders import assign_work_order
from linetally.plans.mart import build_line_day_kpi, read_line_day_kpi, read_machine_time, refresh_line_day_kpi
from linetally.plans.quality import qc_line_day_tally
from linetally.plans.reports import all_reports
from linetally.session import SETTINGS
from linetally.sources import files, snapshots
from linetally.sources.loads import days_of, load_folder, read_rejects
from linetally.sources.schemas import EVENTS, RUNS, TABLES
from linetally.sources.tables import load_tables, read_table, save_table


def run(
    spark: SparkSession,
    root: str,
    out: str,
    as_of: datetime.date | None = None,
    refresh: tuple[datetime.date, datetime.date] | None = None,
    event_log: str | None = None,
    assign: bool = False,
    load: tuple[str, str] | None = None,
    refresh_loaded: bool = False,
) -> list[str]:
    """Returns the paths written.  All reports share one date, today if none is given."""
    if as_of is None:
        as_of = spark.sql("select current_date()").first()[0]
    written = []
    if load is not None:
        load_folder(spark, load[0], root, load[1])
        for name, table in TABLES.items():
            written.append(f"{out}/rejects/{name}")
            read_rejects(spark, root, table).write.mode("overwrite").parquet(written[-1])
    if files.exists(spark, f"{root}/snapshots"):
        tables = snapshots.load_tables(spark, root)
    else:
        tables = load_tables(spark, root, event_log)
    events, machines = tables["fct_machine_events"], tables["dim_machines"]
    runs = tables["fct_production_runs"]
    mart_path = f"{out}/mart"
    if refresh_loaded:  # the last batch may have been loaded by a run that failed afterwards
        refresh = days_of(spark, root, load[1], EVENTS, RUNS)
    if refresh_loaded and refresh is None:
        pass  # the batch has nothing that the mart is made of
    elif refresh is None:
        build_line_day_kpi(mart_path, events, machines, runs)
    else:
        refresh_line_day_kpi(mart_path, events, machines, runs, *refresh)
    written.append(mart_path)
    if assign:
        save_table(assign_work_order(events, machines, runs), f"{out}/assigned_events", EVENTS)
        tables[EVENTS.name] = read_table(spark, f"{out}/assigned_events", EVENTS)
        written.append(f"{out}/assigned_events")
    tally_path = f"{out}/qc_line_day_tally"
    qc_line_day_tally(tables["fct_qc_results"], runs, as_of).write.mode("overwrite").parquet(tally_path)
    written.append(tally_path)
    time, mart = read_machine_time(spark, mart_path), read_line_day_kpi(spark, mart_path)
    reports = all_reports(tables, time, mart, spark.read.parquet(tally_path), as_of)
    for folder, results in (("reports", reports), ("audits", all_audits(tables, TABLES.values()))):
        for name, result in results.items():
            written.append(f"{out}/{folder}/{name}")
            if folder == "reports":
                store_ordered(result, written[-1])  # ranges.read_ordered gives the order back
            else:
                result.write.mode("overwrite").parquet(written[-1])
    return written


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("--tables", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--as-of", type=datetime.date.fromisoformat)
    parser.add_argument("--refresh", type=datetime.date.fromisoformat, nargs=2, metavar=("FIRST", "LAST"))
    parser.add_argument("--event-log")
    parser.add_argument("--assign", action="store_true")
    parser.add_argument("--load", nargs=2, metavar=("FOLDER", "BATCH"))
    parser.add_argument("--refresh-loaded", action="store_true")
    given = parser.parse_args()
    if given.refresh_loaded and not given.load:
        parser.error("--refresh-loaded needs --load")
    spark = SparkSession.builder.appName("linetally").config(map=SETTINGS).getOrCreate()
    options = (given.as_of, given.refresh, given.event_log, given.assign, given.load, given.refresh_loaded)
    for path in run(spark, given.tables, given.out, *options):
        print(path)
    spark.stop()


if __name__ == "__main__":
    main()
