"""Every registered query that has SQL must equal its DuckDB oracle
(row count, column names, order-insensitive values) on the driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from tessera.sources.tables import DRIVER_TABLES

from .conftest import SF_SMALL

KEYS = sorted(se.oracle_sql())


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_is_registered_with_a_builder():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.queries()) >= 140


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = se.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(se.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() >= 0 and "university_rank" in df.columns
