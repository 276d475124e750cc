"""Tables stored together by day, whose changes appear in one step.

    path/data/<table>/batch=<id>/<column>=<day>/...    files of one batch; they never change
    path/snapshots/version-.../                        the folders that make up the tables now

A change writes its rows as a new batch and then a snapshot: the list of folders of all tables,
most of them taken over from the snapshot before.  Readers take the newest complete snapshot, so
that they see all of a change or nothing, and a change that fails can simply be made again.  The list
is no longer than days times tables and batches a day, and is the only thing that is collected.

One writer at a time changes a path; a second one that started from the same snapshot is refused.
"""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from linetally.functions.times import STORED_DAY
from linetally.sources import files
from linetally.sources.schemas import TABLES, Table
from linetally.sources.tables import bloom_options, conform, with_folder_day

_BATCH = re.compile(r"[A-Za-z0-9_-]+")
LISTED = "table_name string, folder string"


class Folder(NamedTuple):
    """A folder of a table's rows, below ``path/data``."""

    table: str
    folder: str

    @property
    def day(self) -> datetime.date | None:
        value = self.folder.rsplit("=", 1)[1]
        return datetime.date.fromisoformat(value) if re.fullmatch(r"\d{4}-\d\d-\d\d", value) else None

    @property
    def batch(self) -> str:
        return self.folder.split("/")[1].removeprefix("batch=")


@dataclass(frozen=True)
class Snapshot:
    version: str | None
    folders: frozenset[Folder]

    def of(self, table: Table) -> list[Folder]:
        return sorted(f for f in self.folders if f.table == table.name)

    def others(self, *tables: Table) -> list[Folder]:
        names = {table.name for table in tables}
        return sorted(f for f in self.folders if f.table not in names)


def _listed(spark: SparkSession, version: str) -> frozenset[Folder]:
    return frozenset(Folder(r.table_name, r.folder) for r in spark.read.schema(LISTED).parquet(version).collect())


def current(spark: SparkSession, path: str) -> Snapshot:
    """The newest snapshot; an empty one without a version where nothing has been stored."""
    found = files.versions(spark, f"{path}/snapshots")
    return Snapshot(found[-1], _listed(spark, found[-1])) if found else Snapshot(None, frozenset())


def existing(spark: SparkSession, path: str) -> Snapshot:
    snapshot = current(spark, path)
    if snapshot.version is None:
        raise FileNotFoundError(f"nothing is stored in {path}")
    return snapshot


def new_batch() -> str:
    return uuid.uuid4().hex


def batch_path(path: str, table: Table, batch: str) -> str:
    if not _BATCH.fullmatch(batch):
        raise ValueError("a batch is named by letters, digits, _ and -")
    return f"{path}/data/{table.name}/batch={batch}"


def write_batch(rows: DataFrame, table: Table, path: str, batch: str | None = None) -> list[Folder]:
    """Write rows as a batch that no snapshot has yet; returns its folders, one per day.

    Rebalancing gathers small days into few files and splits large ones over many tasks.
    Unlike range partitioning it takes no sample, for which Spark would compute the rows twice.
    """
    batch = batch or new_batch()
    out, column = with_folder_day(conform(rows, table), table)
    (
        out.hint("rebalance", column)
        .sortWithinPartitions(column, *table.layout)
        .write.mode("overwrite")
        .options(**bloom_options(table))
        .partitionBy(column)
        .parquet(batch_path(path, table, batch))
    )
    return folders_of(rows.sparkSession, table, path, batch)


def folders_of(spark: SparkSession, table: Table, path: str, batch: str, below: str = "") -> list[Folder]:
    """The folders that a batch has written, directly or below one of its folders."""
    place = batch_path(path, table, batch) + below
    start = f"{table.name}/batch={batch}{below}"
    return [Folder(table.name, f"{start}/{name}") for name, _ in files.folders(spark, place) if "=" in name]


def read(spark: SparkSession, path: str, folders: Iterable[Folder], schema: StructType) -> DataFrame:
    """The rows of some folders of one table; a filter on the day opens only its folders."""
    folders = sorted(folders)
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{path}/data/{folders[0].folder.split('/')[0]}"
    paths = [f"{path}/data/{f.folder}" for f in folders]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(schema.names)


def stored_schema(table: Table) -> StructType:
    """A table's columns, and the day of its folders where that is not one of them."""
    if "day" in table.schema.names:
        return table.schema
    return StructType([*table.schema.fields, StructField(STORED_DAY, DateType(), True)])


def read_table(spark: SparkSession, path: str, table: Table, snapshot: Snapshot | None = None) -> DataFrame:
    snapshot = snapshot or existing(spark, path)
    return read(spark, path, snapshot.of(table), stored_schema(table))


def load_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All declared tables as one snapshot has them."""
    snapshot = existing(spark, path)
    found = {name: read_table(spark, path, table, snapshot) for name, table in TABLES.items()}
    return {name: rows if TABLES[name].layout else rows.drop(STORED_DAY) for name, rows in found.items()}


def publish(
    spark: SparkSession,
    path: str,
    base: Snapshot,
    folders: Iterable[Folder],
    grace_seconds: float = files.GRACE_SECONDS,
) -> str:
    """Make these the folders of all tables, in one step; returns the snapshot's place."""
    newest = current(spark, path).version
    if newest != base.version:
        raise RuntimeError(f"{path} was changed meanwhile: {newest}")
    version = files.new_version(f"{path}/snapshots")
    listed = spark.createDataFrame([tuple(f) for f in sorted(set(folders))], LISTED)
    listed.coalesce(1).write.parquet(version)
    remove_unused(spark, path, grace_seconds)
    return version


def remove_unused(spark: SparkSession, path: str, grace_seconds: float = files.GRACE_SECONDS) -> list[str]:
    """Delete snapshots replaced more than ``grace_seconds`` ago, and folders only they had.

    Batches that never became part of a snapshot go once they are that old.
    """
    place = f"{path}/snapshots"
    before = {version: _listed(spark, version) for version in files.versions(spark, place)}
    old = files.remove_old_versions(spark, place, grace_seconds)
    kept = {f.folder for version, folders in before.items() if version not in old for f in folders}
    removed = sorted({f.folder for version in old for f in before[version]} - kept)
    in_use = {folder.rsplit("/", 1)[0] for folder in kept} | {"/".join(folder.split("/")[:2]) for folder in kept}
    for table, _ in files.folders(spark, f"{path}/data"):
        for batch, modified in files.folders(spark, f"{path}/data/{table}"):
            if f"{table}/{batch}" not in in_use and modified < files.now() - grace_seconds:
                removed.append(f"{table}/{batch}")
    for folder in removed:
        files.remove(spark, f"{path}/data/{folder}")
    return removed
