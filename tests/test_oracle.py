"""Every registered query against its DuckDB statement on the sf0.001 tables
(row count, column names and the multiset of rows), or -- for queries
without an SQL form -- that it runs and returns its declared columns."""

import math

import pytest

from sample_tables import SMALL
from kiln.plans.registry import load_all

REG = load_all()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(n for n, q in REG.items() if q.sql))
def test_matches_oracle(spark, duck, name):
    q = REG[name]
    df = q.run(spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(q.oracle())
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


@pytest.mark.parametrize("name", sorted(n for n, q in REG.items() if not q.sql))
def test_rows_only_queries_run(spark, name):
    df = REG[name].run(spark, SMALL)
    assert df.count() > 0
    assert len(df.columns) > 0


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
