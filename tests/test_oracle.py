"""Every query with oracle SQL matches DuckDB on sf0.001 (the driver checks sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from sifter.sources.tables import TABLES

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _rows(srows) == _rows(orows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
