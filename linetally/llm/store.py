"""Tables written to the folder that all executors share.

They lie below ``llm-<application id>`` there.  Results read them lazily, so they stay until
``remove_stored`` is called, or the folder of an application that has ended is deleted.  What is stored
within ``passing`` goes when it ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from linetally.session import shared_folder
from linetally.sources import files

_folders: dict[str, str] = {}


def _folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    if application not in _folders:
        _folders[application] = f"{shared_folder(spark)}/llm-{application}"
    return _folders[application]


_passing: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_passing[-1] if _passing else _folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored within are deleted at the end; what is to last is written before, elsewhere."""
    _passing.append(fresh_path(spark, "passing"))
    try:
        yield
    finally:
        files.remove(spark, _passing.pop())


def remove_stored(spark: SparkSession) -> None:
    """Delete all tables this application has stored; results that read them are lost."""
    files.remove(spark, _folder(spark))


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows computed now, written as Parquet to the shared folder and read back.

    Losing an executor afterwards costs nothing, and the optimizer knows the real size.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
