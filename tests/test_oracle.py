"""Every registered query against its SQL text on the driver tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.oracle import compare
from wavemeter.plans.catalog import all_queries

REGISTERED, ORACLES = queries(), oracle_sql()
QUERIES = {name: REGISTERED[name] for name in all_queries()}


def test_oracles_name_queries():
    assert set(ORACLES) <= set(REGISTERED)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare(df, ORACLES[name], sf) is None
    else:
        assert df.count() > 0
