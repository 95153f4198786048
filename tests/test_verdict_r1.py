"""Cases that earlier versions got wrong."""

from __future__ import annotations

import os

from conftest import SF_SMALL

from verdant.operators import dashboard as db
from verdant.operators import geo
from verdant.operators import keyed as kt
from verdant.sources import envelope as env
from verdant.sources import fixtures as fx
from verdant.sources import sinks


def _near(spark, search, place):
    s = spark.createDataFrame([(1, *search, 20.0)], "search_id int, lat double, lng double, radius_km double")
    p = spark.createDataFrame([(7, "t", "k", *place)], "place_id int, title string, kind string, lat double, lng double")
    return geo.nearby_many(s, p).count()


def test_radius_crosses_the_180_degree_line_and_a_pole(spark):
    assert _near(spark, (0.0, 179.99), (0.0, -179.99)) == 1
    assert _near(spark, (0.0, -179.99), (0.0, 179.99)) == 1
    assert _near(spark, (89.99, 0.0), (89.99, 180.0)) == 1
    assert _near(spark, (0.0, 179.99), (0.0, 0.0)) == 0


def test_peak_ties_compare_numbers(spark):
    hourly = spark.createDataFrame([("20240101", 9, "20", "R", 5), ("20240101", 10, "20", "R", 5)],
                                   "date string, hour int, user_age string, user_region string, login bigint")
    got = {r.dimension: r.value for r in db.peak_login(hourly).collect()}
    assert got["hour"] == "9"


def test_bus_sink_without_a_partition(spark, scratch):
    path = os.path.join(scratch, "bus")
    sinks.write_bus(spark.createDataFrame([("a",), ("b",)], "value string"), "t", path=path)
    assert {r.value for r in spark.read.json(path).collect()} == {"a", "b"}


def test_logs_join_only_what_is_asked_for(spark):
    plan = fx.logs(spark, SF_SMALL, members=False, parts=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    plan = fx.logs(spark, SF_SMALL, parts=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan
    plan = fx.logs(spark, SF_SMALL, types=("view",))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan or "In(event_type" in plan


def test_topics_in_one_pass_equal_the_union_of_frames(spark):
    logs = fx.logs(spark, SF_SMALL)
    frames = {t: logs.filter(logs.topic == t).select(*kt.COMMON_COLUMNS, *cols)
              for t, cols in kt.TOPIC_COLUMNS.items()}
    whole = kt.union_topics(frames)
    once = kt.select_topics(logs).select(*whole.columns)
    assert whole.exceptAll(once).count() == 0 and once.exceptAll(whole).count() == 0


def test_only_values_without_a_json_form_become_text(spark):
    df = spark.sql("SELECT 'a' s, true b, 1 i, 1.5D d, array(1) l, map('k', 1) m, "
                   "DATE '2024-01-02' day, CAST(2.50 AS DECIMAL(5, 2)) price, "
                   "CAST(NULL AS DATE) none")
    out = env.simple_values(df)
    assert out.schema["l"] == df.schema["l"] and out.schema["m"] == df.schema["m"]
    r = out.first()
    assert (r.s, r.b, r.i, r.d, r.day, r.price, r.none) == ("a", True, 1, 1.5, "2024-01-02", "2.50", None)


def test_receipts_reach_documents_of_the_whole_table(spark):
    plan = fx.receipts(spark, SF_SMALL, documents=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    r = fx.receipts(spark, SF_SMALL)
    assert r.select("ocr_text").distinct().count() > r.count() / 2
