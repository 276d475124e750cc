import compare
import pytest

import __spark_entry__ as entry

QUERIES = entry.line_queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_oracle(spark, sf_dir, con, name):
    assert compare.assert_same(QUERIES[name](spark, sf_dir), con, ORACLE[name]) > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "throughput_per_hour" in rows.columns
