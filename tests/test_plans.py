"""Plan shape of the registered queries: what must never appear, and what
must (pushdown, partial top-k, partial aggregation)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from verdant.plans import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_lookback_pushes_time_range_to_scan(spark):
    plan = _plan(QUERIES["lookback_24h"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_top_k_is_limited_before_the_shuffle(spark):
    for name in ("top5_by_age", "doc_search", "daily_cap"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["member_total"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_hourly_aggregate_is_partial_then_final(spark):
    plan = _plan(QUERIES["common_hourly"](spark, SF_SMALL))
    assert "partial_sum" in plan
