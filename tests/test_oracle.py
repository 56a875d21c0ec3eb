"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from duesight.checks.compare import connect, differences
from duesight.checks.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, connection, name):
    frame = contract.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert banned not in plan
    text, count = differences(frame, connection, name)
    assert text == ""
    if name != "latest_run_filtered":
        assert count > 0


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(contract.oracle_sql()) & set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
