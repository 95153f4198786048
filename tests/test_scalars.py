"""Scalar rules and the reference's dirty-data quirks."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from verdant.functions import scalars as S

AGES = ["none", None, "abc", "9", "10", "19", "20", "59", "60", "75", "-1"]


def _one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col).collect()]


def test_age_band_variants(spark):
    # K5: the three jobs disagree on unknown ages; each variant keeps its rule.
    hourly = _one(spark, S.age_band_hourly("x"), AGES)
    search = _one(spark, S.age_band_search("x"), AGES)
    click = _one(spark, S.age_band_click("x"), AGES)
    assert hourly == [-10, None, None, 0, 10, 10, 20, 50, 60, 60, -10]
    assert search == [99, None, None, 0, 10, 10, 20, 50, 60, 60, -10]
    assert click == [99, 99, 99, 0, 10, 10, 20, 50, 60, 60, -10]


def test_age_band_never_fails_under_ansi(spark):
    # ANSI mode stays on; dirty text must not fail the job.
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert _one(spark, S.age_band_click("x"), ["1,200", "", "x1"]) == [99, 99, 99]
    assert _one(spark, S.age_band_hourly("x"), ["1,200", "", "x1"]) == [None, None, None]


def test_gender_norm(spark):
    assert _one(spark, S.gender_norm("x"), ["none", "W", "M", None]) == ["un", "W", "M", None]


def test_price_parse(spark):
    assert _one(spark, S.parse_price("x"), ["1200", "1,200", None, "9.5"]) == [1200.0, None, None, 9.5]


def test_composite_key_nulls_and_split_with_colon(spark):
    # A null part must not null the key; K13: a word with ':' survives.
    df = spark.createDataFrame([("20240115", None, "a:b")], "d string, g string, w string")
    key = df.select(S.composite_key("d", "g", "w").alias("k")).first().k
    assert key == "20240115:none:a:b"
    parts = df.select(*S.split_key(F.lit(key), 3)).first()
    assert list(parts) == ["20240115", "none", "a:b"]


def test_window_day_text_matches_date_format(spark):
    df = spark.createDataFrame([("2024-01-15 23:10:00",)], "t string") \
        .select(F.to_timestamp_ntz("t").alias("ts")) \
        .select(F.window("ts", "60 minutes").alias("w"))
    r = df.select(S.window_day_text("w").alias("a"), S.day_text("w.start").alias("b")).first()
    assert r.a == r.b == "20240115"


def test_grade_bands(spark):
    totals = [None, 0, 10, 11, 50, 51, 100, 200, 500, 1000, 3000, 10000, 50000, 100000, 100001]
    grades = _one(spark, S.grade("x"), totals, "bigint")
    assert grades == [0, 0, 0, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    temps = _one(spark, S.temperature("x"), [None, 100001], "bigint")
    assert temps == ["14.5°C", "13.5°C"]


def test_receipt_points_repeatable_and_in_range(spark):
    ids = list(range(50))
    a = _one(spark, S.receipt_points("x", "hash"), ids, "bigint")
    b = _one(spark, S.receipt_points("x", "hash"), ids, "bigint")
    assert a == b and set(a) <= {10, 20, 30, 40, 50}
    assert _one(spark, S.receipt_points("x"), [0, 1, 4, 5], "bigint") == [10, 20, 50, 10]


def test_contains_any_matches_every_keyword(spark):
    # An `or` chain of literals only tests the first; we test all.
    texts = ["무 라 벨 생수", "노라벨 제품", "라벨 있음", None]
    assert _one(spark, S.contains_any("x", S.RECEIPT_KEYWORDS), texts) == [True, True, False, None]


def test_route_and_redact(spark):
    keys = ["login", "logout", "2", "click", "search", "1"]
    assert _one(spark, S.route_partition("x"), keys) == [0, 1, 1, 1, 0, 0]
    assert _one(spark, S.route_topic("x"), keys) == [
        "log_inout", "log_inout", "log_ecopoint", "log_nolabel", "log_nolabel", "log_ecopoint"]
    m = spark.range(1).select(F.create_map(F.lit("password"), F.lit("x"), F.lit("member_id"),
                                           F.lit("7"), F.lit("topic"), F.lit("t")).alias("m"))
    assert m.select(S.redact("m")).first()[0] == {"member_id": "7"}


def test_wall_time_text(spark):
    df = spark.createDataFrame([("2024-01-15 00:00:00.123456",)], "t string") \
        .select(F.to_timestamp_ntz("t").alias("ts"))
    assert df.select(S.wall_time_text("ts")).first()[0] == "2024-01-15T09:00:00.123Z"
    assert df.select(S.wall_time_text("ts", 0)).first()[0] == "2024-01-15T00:00:00.123Z"


def test_metric_label_and_logged_age(spark):
    assert _one(spark, S.metric_label("x"), ["menu_eco1", "menu_lesswaste"]) == ["ECO1", "LESSWASTE"]
    df = spark.createDataFrame([("1990-05-01",)], "b string")
    assert df.select(S.logged_age("b", F.lit("2024-01-16").cast("date"))).first()[0] == 35


def test_bounding_box_contains_circle():
    # The box must be a superset of the spherical cap at any latitude.
    for lat in (0.0, 37.5, 60.0, 80.0):
        for km in (1, 10, 20, 500):
            r = S.km_to_radians_value(km)
            dlat, dlng = S.bounding_box(lat, r)
            assert dlat >= math.degrees(r)
            # sample the circle boundary
            for i in range(360):
                b = math.radians(i)
                la1 = math.radians(lat)
                la2 = math.asin(math.sin(la1) * math.cos(r) + math.cos(la1) * math.sin(r) * math.cos(b))
                dl = math.atan2(math.sin(b) * math.sin(r) * math.cos(la1),
                                math.cos(r) - math.sin(la1) * math.sin(la2))
                assert abs(math.degrees(la2) - lat) <= dlat
                if dlng is not None:
                    assert abs(math.degrees(dl)) <= dlng


def test_gender_label(spark):
    assert _one(spark, S.gender_label("x"), ["M", "W"]) == ["남성", "여성"]
