"""Events meet ``part`` on ``k``, which has few values: a part table beyond the
broadcast bound is cut to the parts that events name, so events aren't shuffled by ``k``."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from verdant.plans import QUERIES
from verdant.sources import fixtures as fx

NAMES = ("search_daily", "click_daily", "search_rollup", "top5_by_age", "price_parse")


@pytest.fixture
def no_small_sides(spark):
    """As on a cluster whose dimension tables are beyond the broadcast bound."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def _rows(df):
    return sorted(map(str, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_events_are_not_shuffled_by_part(spark, no_small_sides, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "hashpartitioning(cast(k#" not in plan and "hashpartitioning(k#" not in plan
    assert "BroadcastHashJoin" in plan


def test_every_way_gives_the_same_rows(spark, monkeypatch):
    small = _rows(fx.logs(spark, SF_SMALL))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        cut = fx.logs(spark, SF_SMALL, members=False)
        assert "BroadcastHashJoin" in _plan(cut)
        assert _rows(fx.logs(spark, SF_SMALL)) == small
        monkeypatch.setattr(fx, "FEW_PARTS", 3)
        merged = fx.logs(spark, SF_SMALL, members=False)
        assert "SortMergeJoin" in _plan(merged) and "BroadcastHashJoin" not in _plan(merged)
        assert _rows(fx.logs(spark, SF_SMALL)) == small
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def test_part_rows_that_repeat_are_counted_before_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(fx, "FEW_PARTS", 2)
    ev = spark.createDataFrame([(1,), (None,), (1,)], "k int")
    part = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d")], "p_partkey bigint, p_name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert fx._named_parts(ev, part) is part
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
