"""Every registered query against its oracle SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from latebook.catalog import ORACLES, QUERIES
from tools.compare import database, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() == 150
    assert set(entry.oracle_sql()) <= set(entry.queries())
