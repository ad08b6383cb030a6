"""Every registered query runs; those with a SQL twin give the same rows in DuckDB."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLES:
        assert difference(got, duck.execute(ORACLES[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
