"""Properties and quirk decisions (SURVEY 1.4) not covered elsewhere."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.operators import dashboard as db
from verdant.operators import keyed as kt
from verdant.operators import members as mb
from verdant.operators import segments as seg
from verdant.sources import fixtures as fx


def test_segment_counts_sum_to_raw_key_counts(spark):
    logs = fx.logs(spark, SF_SMALL)
    h = seg.common_hourly(logs).agg(*[F.sum(m).alias(m) for m in seg.METRIC_NAMES]).first()
    raw = {r.key: r["count"] for r in logs.groupBy("key").count().collect()}
    assert h.login == raw["login"] and h.logout == raw["logout"]
    assert h.nolabel_search == raw["search"] and h.nolabel_click == raw["click"]
    assert h.ecopoint1_click == raw["1"] and h.ecopoint2_click == raw["2"]
    menus = logs.filter(F.col("key") == "menuclick").count()
    assert h.menu_nolabel + h.menu_eco1 + h.menu_eco2 + h.menu_lesswaste == menus
    pts = logs.filter(F.col("key") == "1").agg(F.sum("save_point")).first()[0]
    assert h.save_ecopoint1 == pts


def test_rollup_total_equals_flat_total(spark):
    hourly = seg.common_hourly(fx.logs(spark, SF_SMALL))
    r = db.menu_rollup(hourly)
    grand = r.filter(F.col("level") == 15).first().click
    flat = hourly.agg(sum(F.sum(m) for m in db.MENU_METRICS)).first()[0]
    assert grand == flat
    per_day = r.filter(F.col("level") == 7).agg(F.sum("click")).first()[0]
    assert per_day == flat


def test_hour_is_part_of_the_key(spark):
    # K2: hours of one day must not overwrite each other.
    hourly = seg.common_hourly(fx.logs(spark, SF_SMALL))
    keyed = kt.with_key(hourly, kt.COMMON_KEY_PARTS)
    assert keyed.select("key").distinct().count() == keyed.count()


def test_unmatched_click_rows_only_when_asked(spark):
    # K9: the reference kept non-click rows as all-null rows.
    logs = fx.logs(spark, SF_SMALL).filter(F.col("topic") == "log_nolabel")
    kept = seg.click_events(logs, keep_unmatched=True)
    assert kept.count() == logs.count()
    assert kept.filter(F.col("product_name").isNull()).count() == \
        logs.filter(F.col("key") != "click").count()
    assert seg.click_events(logs).count() == logs.filter(F.col("key") == "click").count()


def test_member_lookup_uses_logged_age_band(spark):
    # A member logged as 75 is in band 60, so the lookup must use 60 too.
    members = spark.createDataFrame([("1", "M", "1950-01-01")], "member_id string, gender_kb string, birth_dt string")
    top = spark.createDataFrame([("20240115", 60, "w", 3, 1)],
                                "date string, age bigint, word string, count bigint, rank int")
    got = mb.member_top_words(members, top, "20240115", "age", "2024-01-16").collect()
    assert [(r.member_id, r.word) for r in got] == [("1", "w")]


def test_ratios_are_null_on_zero_denominator(spark):
    # K19
    hourly = spark.createDataFrame(
        [("20240101", 1, 20, "ASIA", "W", *([0] * 13))],
        "date string, hour int, user_age bigint, user_region string, user_gender string, " +
        ", ".join(f"{m} bigint" for m in seg.METRIC_NAMES))
    assert all(r.percent is None for r in db.demand_ratios(hourly).collect())
    assert db.visitor_share(hourly).first().user_share is None


def test_lookback_window_follows_as_of(spark):
    # [as_of - 29 h, as_of - 5 h), independent of the wall clock.
    rows = [(dt.datetime(2024, 1, 14, 23, 59, 59),), (dt.datetime(2024, 1, 15, 0, 0),),
            (dt.datetime(2024, 1, 15, 23, 59, 59),), (dt.datetime(2024, 1, 16, 0, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r.ts.day for r in seg.lookback(df, "2024-01-16 05:00:00").orderBy("ts").collect()]
    assert got == [15, 15]


def test_session_sentinels_are_parameters():
    # K6: both visitor sentinels stay available as named values.
    assert S.VISITOR == "none" and S.SEARCH_VISITOR_GENDER == "un"
