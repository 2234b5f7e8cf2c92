"""Every registered query gives the rows of its SQL on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import difference, duckdb_on
from workload import expected
from workload.catalog import PLANS, Layers, comparable

SF_DIR = "/root/testdata/sf0.001"
SQL = expected.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return duckdb_on(SF_DIR)


@pytest.fixture(scope="module")
def layers(spark):
    """The tables that many queries start from, computed once for this module."""
    layers = Layers(spark, SF_DIR)
    shared = [layers.merchants(), layers.customers(), layers.cards(), layers.transactions(), layers.spend(),
              layers.risk(), layers.segments()]
    for table in shared:
        table.cache()
    yield layers
    for table in shared:
        table.unpersist()


def test_every_query_has_sql():
    assert set(SQL) == set(PLANS)
    assert set(PLANS) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_matches_sql(layers, oracle, name):
    assert difference(comparable(PLANS[name](layers)), oracle, SQL[name]) is None


def test_flagship(spark):
    assert "is_anomalous_spend" in contract.entry(spark).columns
