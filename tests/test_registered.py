"""Every registered query against its SQL counterpart."""

import pytest
from helpers import SF

import __spark_entry__ as contract
from checks import registry
from checks.compare import compare, database


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, SF, name, contract.queries()[name], contract.oracle_sql().get(name), con) == ""


def test_entry_counts_the_alerts(spark):
    assert contract.entry(spark).count() == 405


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(contract.queries()) >= set(registry.QUERIES)


def test_differing_rows_are_found_in_one_pass(spark):
    from checks.cases_io import _differing

    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 1.0), (None, None), ("b", 2.0), ("b", None)], "k string, v double")
    right = spark.createDataFrame([("a", 1.0), (None, None), ("c", 2.0), ("c", 2.0), ("b", 2.0)], "k string, v double")
    expected = left.exceptAll(right).unionByName(right.exceptAll(left))
    found = _differing(left, right)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.count() == 5
    assert _differing(left, left).count() == 0
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2  # each side once
