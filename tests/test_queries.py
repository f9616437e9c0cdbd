"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from bindings.queries import QUERIES
from tests.compare import compare, duck

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(D)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    sql = entry_points.oracle_sql().get(name)
    assert sql, f"{name} has no SQL"
    ok, note = compare(spark, con, D, entry_points.queries()[name], sql)
    assert ok, note


def test_entry_has_a_stable_schema(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["channel", "best_hour", "videos", "has_enough", "label"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
