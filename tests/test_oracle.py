"""Every registered query against its DuckDB oracle on the smallest driver folder."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest
from conftest import SF_SMALL

from __spark_entry__ import entry, oracle_sql, queries
from innkeep.oracles import all_oracles
from innkeep.plans.catalog import all_queries

TABLES = ["orders", "customer", "nation"]
NAMES = sorted(all_queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(all_oracles()) == set(all_queries())
    assert set(all_queries()) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "popularity_rank" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _rows(sdf.columns, srows) == _rows(ocols, res.fetchall())
