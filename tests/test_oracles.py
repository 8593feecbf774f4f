"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, connect
from tidegauge.plans.oracles import ORACLES
from tidegauge.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    problem = compare(queries()[name](spark, sf_dir), duck, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry(spark).count() > 0
