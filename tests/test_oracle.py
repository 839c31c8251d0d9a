"""Every registered query against its DuckDB oracle SQL on sf0.001 (the driver's gate runs sf0.01)."""

import pytest

import __spark_entry__ as entry
from tessera.plans.compare import compare, duck
from tessera.plans.oracle import SQL
from tessera.plans.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(QUERIES[name](spark, sf_small), con, SQL[name])
    spark.catalog.clearCache()
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["set_id", "doc"] and df.count() > 0
    spark.catalog.clearCache()
