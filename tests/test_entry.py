"""Driver contract and oracle parity of every registered query at sf0.001."""

import contextlib
import datetime as dt
import decimal
import io

import duckdb
import pytest

import __spark_entry__ as E
from dimforge.plans import registry
from dimforge.sources.tables import TABLES
from tests.conftest import SF_SMALL


def norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_per_100k" in df.columns and "place_name" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_oracle_parity(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert not [f for f in FORBIDDEN if f in plan], "row-at-a-time Python or all-pairs join in the plan"
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert canon(s_cols, s_rows) == canon(d_cols, d_rows)
