"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest driver tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from isobar.plans.oracle import ORACLE
from isobar.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def _full(cols, rows):
    """Rows in a canonical order (sorted on values rounded to 4 places), with
    the full values kept for a tolerant float comparison."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    full = [tuple(r[i] for i in order) for r in rows]
    full = [tuple(v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v for v in r)
            for r in full]
    return sorted(full, key=lambda t: tuple((x is None, str(_norm(x))) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = ORACLE.get(name)
    if sql is None:
        pytest.skip("no oracle")
    rel = duck.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = _full(df.columns, srows), _full(rel.columns, rel.fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if isinstance(a, float) and isinstance(b, float):
                assert abs(a - b) <= 2e-6, (g, w)  # both sides rounded to 6 places
            else:
                assert a == b, (g, w)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["fhours", "count"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.queries())
