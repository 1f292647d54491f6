"""Registered queries of this package: against SQL where there is some, on the smallest tables."""

import pytest

from candles.llm.oracles import ORACLES
from candles.llm.queries import QUERIES
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    n, diff = differences(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name])
    assert n > 0
    assert not diff
