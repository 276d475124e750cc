"""Folders of results that readers see only once they are complete.

A result is written to a folder of its own, ``version-<microseconds>-<id>`` below its path.
Spark marks a folder it has written completely with ``_SUCCESS``; readers take the newest marked
one.  Older ones stay for a while, for readers that started earlier.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

GRACE_SECONDS = 86_400
_PREFIX = "version-"


def _at(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system and path, which any store Spark can read has."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names of the folders in a folder, and when each was last changed (seconds)."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    found = [status for status in files.listStatus(place) if status.isDirectory()]
    return sorted((status.getPath().getName(), status.getModificationTime() / 1000) for status in found)


def now() -> float:
    return time.time()


def new_version(path: str) -> str:
    return f"{path}/{_PREFIX}{time.time_ns() // 1000:020d}-{uuid.uuid4().hex[:8]}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The complete versions, oldest first."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    names = sorted(status.getPath().getName() for status in files.listStatus(place))
    return [f"{path}/{name}" for name in names if name.startswith(_PREFIX) and exists(spark, f"{path}/{name}/_SUCCESS")]


def current_version(spark: SparkSession, path: str) -> str:
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version in {path}")
    return found[-1]


def remove_old_versions(spark: SparkSession, path: str, grace_seconds: float = GRACE_SECONDS) -> list[str]:
    """Delete versions that were replaced more than ``grace_seconds`` ago; returns them."""
    found, before = versions(spark, path), (time.time() - grace_seconds) * 1e6
    started = [int(name.rsplit("/", 1)[1].removeprefix(_PREFIX).split("-")[0]) for name in found]
    old = [name for name, replaced in zip(found, started[1:]) if replaced < before]
    for name in old:
        remove(spark, name)
    return old
