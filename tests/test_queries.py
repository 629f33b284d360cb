"""Every registered query against its SQL oracle, and the driver's entry points."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    assert difference(spark, duck, name, SF_DIR) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_stays_in_spark_without_pairing_all_rows(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, REPARTITION"):
        assert unwanted not in plan


def test_entry_has_all_branches(spark):
    df = contract.entry(spark)
    reasons = {r["reason"] for r in df.select("reason").distinct().collect()}
    assert reasons == {"deleted_at_source", "new", "uncommitted", "up_to_date", "source_newer"}
