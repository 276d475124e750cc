"""Column names of any kind: with dots, quotes, or the names that operators use themselves."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of that very name."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(name: str, taken: Iterable[str]) -> str:
    """name, or that with underscores, so that it differs from all taken ones in any case."""
    lower = {other.lower() for other in taken}
    while name.lower() in lower:
        name += "_"
    return name
