"""Plan-shape guards over every registered query: no cross products, no
nested-loop joins (the reference's range and calendar joins must stay
rewritten as equi-joins and explodes)."""

import pytest

import __spark_entry__ as entry
from conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_no_cross_products(spark, key):
    df = entry.queries()[key](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{key}: {found}"
