"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = Path("/root/testdata/sf0.001")
ORACLE = entry_point.oracle_sql()
QUERIES = entry_point.queries()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="shared tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def ordered(listed, names):
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[p] for p in places) for r in listed), key=repr)


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, str(SF))
    got = ordered(found.collect(), found.columns)
    assert got
    if name in ORACLE:
        result = duck.execute(ORACLE[name])
        names = [c[0] for c in result.description]
        expected = ordered(result.fetchall(), names)
        assert sorted(names) == sorted(found.columns)
        assert len(got) == len(expected)
        assert all(same(x, y) for g, e in zip(got, expected) for x, y in zip(g, e))


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 200
