"""Every registered query against its DuckDB SQL on the smallest scale."""

import pytest

import __spark_entry__ as entry_module
from gridtide.plans import catalog, oracle
from tests import compare

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
SQL = oracle.SQL


@pytest.fixture(scope="module")
def duck():
    return compare.duckdb_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    r = compare.compare(spark, duck, name, QUERIES[name], SQL[name], SF)
    assert r["columns_match"], (r["spark_cols"], r["duck_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"]


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert "Season" in df.columns
