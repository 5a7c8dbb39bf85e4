"""Every query with a SQL form gives the same rows as the SQL on the same files; the others give rows."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
SLOW = {"m04_classifiers", "m05_resampled_cross_validation", "m09_feature_importance", "m18_tree_attribution", "c02_penalty_sweep", "c03_fit_spend", "c01_fit_purchases"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, sf, name):
    assert compare(spark, con, sf, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 5 and df.columns == entry.entry(spark).columns
