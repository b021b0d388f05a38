"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import datetime as dt
import decimal

import duckdb
import pytest

from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def _names():
    from triage.registry import load_all
    return sorted(n for n, q in load_all().items() if q.sql)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, registry, duck, name):
    q = registry[name]
    df = q.run(spark, SF001)
    s_cols, s_rows = _canon(df.columns, df.collect())
    cur = duck.execute(q.sql)
    d_cols, d_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
