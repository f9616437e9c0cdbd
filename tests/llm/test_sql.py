"""Queries that SQL can express, against it."""

import pytest

from lectern.llm import queries as Q
from tests.compare import compare, duck

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, name):
    ok, note = compare(spark, duck(D), D, Q.QUERIES[name], Q.ORACLES[name])
    assert ok, note


def test_one_query_per_operator():
    for n in range(1, 14):
        assert len([q for q in Q.QUERIES if q.startswith(f"op{n}_")]) == 1
