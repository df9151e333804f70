"""Every registered query against its DuckDB oracle on the smallest test
scale (the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from chartlake.registry import QUERIES
from tools.oracle_check import TABLES, digest

from tiny import SF_SMALL

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_warehouse_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(df.columns, s_rows) == digest(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert df.columns[:2] == ["season", "danceability"]
