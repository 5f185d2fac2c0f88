"""Every registered query on the smallest tables, next to its SQL cross-check."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from fieldlens.plans.registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def check(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def exact_part(row):
    """Sort key: values that are compared exactly, then the measured ones."""
    return ([str(v) for v in row if not isinstance(v, float)],
            [v for v in row if isinstance(v, float)])


def same(x, y):
    """Engines add doubles in different orders, so a rounding tie may fall either way."""
    if isinstance(x, float) and isinstance(y, float):
        return math.isclose(x, y, rel_tol=1e-6, abs_tol=1.01e-4)
    return str(x) == str(y)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    without = set(QUERIES) - set(ORACLES)
    assert not without


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, check, name):
    df = entry.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = check.execute(sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=exact_part), sorted(want, key=exact_part)):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)
