"""Every registered query against its DuckDB oracle on sf0.001 (rows-only for the rest)."""

import datetime as dt
import decimal
from collections import Counter

import duckdb

import __spark_entry__ as E
from fedlake.session import TABLES
from tests.conftest import SMOKE


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_registry_shape():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(sqls) >= 150


def test_all_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sqls = E.oracle_sql()
    bad = []
    for name, fn in E.queries().items():
        df = fn(spark, SMOKE)
        rows, cols = df.collect(), df.columns
        if name not in sqls:
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        si = sorted(range(len(cols)), key=lambda i: cols[i])
        di = sorted(range(len(dcols)), key=lambda i: dcols[i])
        if sorted(cols) != sorted(dcols) or Counter(tuple(_norm(r[i]) for i in si) for r in rows) != \
                Counter(tuple(_norm(r[i]) for i in di) for r in drows):
            bad.append(name)
    assert bad == []
