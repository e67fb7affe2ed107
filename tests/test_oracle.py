"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidewater.sources.tables import TABLE_NAMES

from shared import SMALL

ORACLE = oracle_sql()


def _norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 5


def test_every_query_has_oracle_or_is_listed():
    assert set(ORACLE) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SMALL)
    got = df.collect()
    if name not in ORACLE:
        return
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in cols)
    assert _rows(df.columns, [tuple(r) for r in got]) == _rows(cols, res.fetchall())
