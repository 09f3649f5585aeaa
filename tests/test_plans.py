"""Plan-shape guarantees of every registered query."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

PYTHON_ALLOWED: set[str] = set()   # no Python UDF anywhere


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_pair_explosion_and_no_row_udfs(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python UDF
    if key not in PYTHON_ALLOWED:
        assert "ArrowEvalPython" not in plan


def test_fact_scans_push_filters(spark):
    plan = _plan(E.queries()["top3_per_sensor"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate,1998-12-01T00:00)" in plan
    assert "WindowGroupLimit" in plan
    plan = _plan(E.queries()["range_read"](spark, SF_SMALL))
    assert "EqualTo(user_id,5)" in plan


def test_dimensions_are_broadcast_not_facts(spark):
    plan = _plan(E.queries()["rolling_24h"](spark, SF_SMALL))
    # the hinted (dimension) side is the build side; the events scan streams
    assert "BuildRight" in plan
