"""Every registered query with an oracle matches DuckDB on sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from revlens.sources.tables import TABLES
from tools.oracle_check import rows_of

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(srows, cols, 6) == rows_of(drows, cols, 6)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["CustomerID", "daysSinceLastOrder", "orderCount", "sumRevenue"]
    assert df.count() >= 0
