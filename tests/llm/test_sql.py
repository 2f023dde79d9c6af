"""Queries whose rows SQL can give, and the shape of the registered ones."""

import pytest
from check import compare
from haulframe.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sql, sf_dir, name):
    assert compare(spark, sql, name, sf_dir) is None


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
