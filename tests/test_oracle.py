"""Every registered query against its DuckDB oracle (the driver's check).

Runs at sf0.001 by default (VERDANT_ORACLE_DIR overrides, e.g. sf0.01, the
driver's scale; ``python tests/run_oracle.py`` prints the same per query).
"""

from __future__ import annotations

import os

import pytest
from oracle_harness import compare, duck

from verdant.plans import ORACLE, QUERIES

DATA = os.environ.get("VERDANT_ORACLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], DATA)
    assert r["ok"], r.get("error")


@pytest.mark.parametrize("name", ["click_daily", "lookback_24h", "common_hourly", "decode_envelope",
                                  "session_windows", "member_vs_all"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    # The driver's session may use any zone; event times are wall-clock values.
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, con, name, QUERIES[name], ORACLE[name], DATA)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r.get("error")
