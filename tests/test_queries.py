from __future__ import annotations

import check_queries as cq
import pytest

import __spark_entry__ as entry
from faturaflow.plans import oracle
from faturaflow.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return cq.duck(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle.all_sql()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    assert cq.compare(spark, con, SF, name) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "message_id" and df.count() > 0
