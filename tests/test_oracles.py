"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from candles.plans import queries
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
#: The training-data operators have tests of their own.
QUERIES = {name: q for name, q in entry.queries().items() if name in queries.QUERIES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in queries.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    n, diff = differences(spark, con, FOLDER, QUERIES[name], ORACLES[name])
    assert n > 0
    assert not diff


def test_only_the_trained_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"ml_metrics"}
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 16 and df.count() == 5334
