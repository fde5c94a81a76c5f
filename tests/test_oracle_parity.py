"""Every registered query against its DuckDB oracle on the smallest driver data set."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(df.columns) > 0
        return
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "no_show_rate_pct" in df.columns
