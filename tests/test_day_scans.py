"""The day scans are plain partition reads of a stored table."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

from verdant.plans import QUERIES
from verdant.sources import fixtures as fx


@pytest.mark.parametrize("name", ["scan_common_day", "scan_search_day"])
def test_day_scan_reads_one_partition_and_nothing_else(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in filters and fx.DASHBOARD_DAY in filters
    assert not any(op in plan for op in ("Aggregate", "Exchange", "Window", "Join"))
