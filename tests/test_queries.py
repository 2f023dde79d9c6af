"""Every named query against its SQL, and the shape of the driver's entry points."""

import pytest

from __spark_entry__ import FLAGSHIP, entry, oracle_sql, queries
from check import compare
from haulframe.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, sf_dir, name):
    assert compare(spark, sql, name, sf_dir) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_flagship(spark):
    rows = entry(spark).collect()
    assert rows and FLAGSHIP in queries()
    assert {r.seqnum for r in rows} <= {1, 2, 3}
