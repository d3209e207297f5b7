"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

SMALLEST = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    problem = compare(spark, name, SMALLEST)
    assert problem is None, problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["vec_id", "label", "distance_to_cluster", "closest_cluster"] and df.count() == 500


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
