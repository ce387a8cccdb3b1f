"""Every query of the core against its SQL, over whole tables."""

import glob
import os
from pathlib import Path

import duckdb
import pytest

from quayline.plans import catalog

DATA = os.environ.get("QUAYLINE_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
SLOW = {"mle_02_classifiers", "mle_03_regressors"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {Path(path).stem} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return repr(value) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_like_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    expected = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    order = [expected.columns.index(c) for c in df.columns]
    got = sorted(tuple(map(plain, r)) for r in df.collect())
    assert got == sorted(tuple(plain(r[k]) for k in order) for r in expected.fetchall())


#: Columns and least rows of the queries without SQL; the learners run in test_learning with few trees.
WITHOUT_SQL = sorted(set(QUERIES) - set(SQL) - SLOW)


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_without_sql(spark, name):
    """Rows, no column that is always null, and the same rows when run again."""
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    assert rows or "snk_13" in name
    assert not rows or all(any(r[c] is not None for r in rows) for c in df.columns)
    again = QUERIES[name](spark, DATA).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_flagship(spark):
    assert catalog.flagship(spark, DATA).count() > 0
