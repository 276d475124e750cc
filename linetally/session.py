"""Session settings.

Results do not depend on these settings, as all timestamps are zone-free and every literal
states its type, but for one: "today" is the date in the session's time zone.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "linetally", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    for name, value in {**settings, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without it; it gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):  # executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="linetally-")


def checkpointed(rows: DataFrame) -> DataFrame:
    """rows computed now and kept in the shared folder, out of reach of executor losses."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return rows.checkpoint()


@contextmanager
def checkpoint_folder(spark: SparkSession) -> Iterator[str]:
    """A checkpoint folder of its own, in the shared one, that is deleted afterwards."""
    from linetally.sources import files

    folder, context = f"{shared_folder(spark)}/checkpoints-{uuid.uuid4().hex}", spark.sparkContext
    before = context.getCheckpointDir()
    context.setCheckpointDir(folder)
    try:
        yield folder
    finally:
        files.remove(spark, folder)
        context.setCheckpointDir(before or shared_folder(spark))
