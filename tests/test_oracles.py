"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from strata.plans.oracles import ORACLES
from strata.plans.queries import QUERIES
from strata.plans.compare import differences, oracle_connection
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


SLOW_NODES = ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    result = QUERIES[name](spark, SMALL)
    problems, _, _ = differences(spark, name, lambda *_: result, ORACLES[name], SMALL, connection)
    assert problems == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert [node for node in SLOW_NODES if node in plan] == []


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    result = entry(spark)
    assert result.columns[:2] == ["pickup_date", "total_trips"]
    assert result.count() > 0
