"""Plan properties of every registered query, and each query against its
DuckDB oracle on the smallest driver scale (the driver's gate, locally)."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.oracles import ORACLES
from strata.plans.queries import QUERIES
from strata.plans.staged import BASE_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plan_and_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, df.collect()) == _rows(res.columns, res.fetchall())


def test_flagship_prunes_columns_and_shuffles_once(spark):
    df = E.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan                      # map-side combine before the shuffle
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>" in plan
    assert df.count() > 0
