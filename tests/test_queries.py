"""Every registered query against its SQL counterpart, and the shape of its plan."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlake.queries import registered
from oracle.statements import statements
from tools.compare import INPUTS, canonical, type_differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = statements()
WITHOUT_SQL = {"source_fingerprint", "propensity_classifier"}
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="input tables are not here")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in INPUTS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(registered()) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(registered())
    assert set(registered()) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, engine, name):
    df = registered()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]
    mine = canonical(df.columns, [tuple(row) for row in df.collect()])
    assert mine[1]
    if name in SQL:
        cursor = engine.execute(SQL[name])
        assert type_differences(df, cursor.description) == []
        assert mine == canonical([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["week_start", "category"]
    assert df.count() > 0


def test_no_query_joins_lines_without_need(spark):
    """Column pruning reaches the scan: the executive mart reads neither prices nor cities."""
    df = queries()["mart_executive"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "geography_key" not in plan and "unit_price" not in plan
