"""The queries with SQL against DuckDB, and every query's row count, on the smallest tables."""

import duckdb
import pytest

from compare import TABLES, canonical, difference
from shelfwise.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    got, want = QUERIES[name](spark, SF).toPandas(), db.sql(ORACLES[name]).df()
    assert len(got) > 0 and difference(canonical(got), canonical(want)) == ""


@pytest.mark.parametrize("name", ["op4_imatch", "op5_secrets", "op8_pii"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
