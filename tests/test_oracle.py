"""Every registered query against its DuckDB oracle on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from skyfare.plans.catalog import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in recs]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_engine_query_has_an_oracle():
    """Keys of the training-data operators have their own tests in tests/llm."""
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(E.oracle_sql()) == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["route_code", "departure_date", "price_aud", "airline_code", "stops", "quote_day"]
    assert len(df.collect()) > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for python_eval in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                        "MapInPandas", "PythonUDF"):
        assert python_eval not in plan
    assert sorted(s_cols) == sorted(o_cols)
    assert _rows(s_cols, s_rows) == _rows(o_cols, o_rows)
