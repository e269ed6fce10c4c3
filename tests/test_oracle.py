"""Every query that has SQL gives what DuckDB gives on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(v):
    if v is None or isinstance(v, (bool, str, bytes)):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def tables(small):
    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, tables, name):
    df = QUERIES[name](spark, small)
    result = tables.sql(SQL[name])
    columns = list(result.columns)
    assert sorted(columns) == sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == sorted(tuple(plain(v) for v in r) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.columns
    df.write.format("noop").mode("overwrite").save()


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert {f"p{n}_found" for n in range(1, 7)} <= set(QUERIES)


def test_entry(spark):
    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("no test tables")
    assert entry.entry(spark).count() > 0
