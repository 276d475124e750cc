"""Making this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

_shipped: set[str] = set()


def shipped(rows: DataFrame) -> DataFrame:
    """rows, once Spark hands the package's sources to all Python workers of the application.

    Sessions started with ``--py-files`` or a PYTHONPATH do not need it; it does no harm there.
    """
    context = rows.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = os.path.join(tempfile.mkdtemp(prefix="linetally-"), "linetally_sources.zip")
        with zipfile.ZipFile(archive, "w") as target:
            for source in sorted(package.rglob("*.py")):
                target.write(source, source.relative_to(package.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return rows
