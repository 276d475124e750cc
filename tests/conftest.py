import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from linetally.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        8,
        "tests",
        **{
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": warehouse,
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture
def make(spark):
    """make(table, rows): a DataFrame with the declared schema from plain tuples."""
    import datetime

    from pyspark.sql.types import DateType, TimestampNTZType

    def value(kind, v):
        if isinstance(v, str) and isinstance(kind, TimestampNTZType):
            return datetime.datetime.fromisoformat(v)
        if isinstance(v, str) and isinstance(kind, DateType):
            return datetime.date.fromisoformat(v)
        return v

    def build(table, rows, strict=True):
        from pyspark.sql.types import StructField, StructType

        schema = table.schema
        if not strict:
            schema = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
        typed = [tuple(value(f.dataType, v) for f, v in zip(schema.fields, row, strict=True)) for row in rows]
        return spark.createDataFrame(typed, schema)

    return build
