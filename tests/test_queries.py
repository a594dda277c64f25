"""Every query with an oracle gives the same rows in both engines; no plan falls back to nested loops."""

import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from checks import ORACLES, QUERIES
from compare import TABLES, canonical, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    want = db.sql(ORACLES[name]).df()
    got = df.toPandas()
    if len(got) == 0:
        assert len(want) == 0
    else:
        assert difference(canonical(got), canonical(want)) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["item_code", "day_dt", "ttl_quantity", "unit_price", "p_rate", "n_sold"]
    assert df.count() > 0


def test_comparison_notices_differences():
    a = pd.DataFrame({"k": ["a", None], "v": [1.0, 2.0]})
    assert difference(canonical(a), canonical(a.iloc[::-1])) == ""
    assert difference(canonical(a), canonical(a.assign(v=[1.0, 2.0001]))) != ""
    assert difference(canonical(a), canonical(a.assign(k=["a", "b"]))) != ""
    assert difference(canonical(a), canonical(a.head(1))) != ""
