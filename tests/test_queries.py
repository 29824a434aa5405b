"""Every census query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from tests.oracle import assert_same, connect

from tractworks.plans.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert_same(QUERIES[name](spark, DIR), con, SQL[name])


def test_entry_is_stable(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 12 * df.select("CD_MUN").distinct().count()
    assert {"pct_do_total", "delta_pp", "comparador"} <= set(df.columns)


def test_all_registered_queries_are_callable():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(map(callable, e.queries().values()))
