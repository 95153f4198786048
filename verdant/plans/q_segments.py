"""Queries over the three log jobs and their scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.operators import segments as seg
from verdant.plans.registry import register
from verdant.plans.sql_views import (age_click_sql, age_hourly_sql, age_search_sql,
                                     with_views)
from verdant.sources import fixtures as fx

HOURLY_SQL_METRICS = ",\n".join(
    f"  CAST(sum(CASE WHEN {col} = '{val}' THEN {1 if summed is None else summed} ELSE 0 END)"
    f" AS BIGINT) AS {name}"
    for name, col, val, summed in seg.HOURLY_METRICS)

COMMON_HOURLY_SQL = f"""
SELECT strftime(ts, '%Y%m%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
  {age_hourly_sql('user_age')} AS user_age, user_region, user_gender,
{HOURLY_SQL_METRICS}
FROM logs GROUP BY 1, 2, 3, 4, 5"""

SEARCH_DAILY_SQL = f"""
SELECT strftime(ts, '%Y%m%d') AS date,
  CASE WHEN user_gender = 'none' THEN 'un' ELSE user_gender END AS gender,
  {age_search_sql('user_age')} AS age, search_word AS word, count(*) AS count
FROM logs WHERE key = 'search' GROUP BY 1, 2, 3, 4"""

AS_OF = fx.LOGS_AS_OF
LO, HI = (t.strftime("%Y-%m-%d %H:%M:%S") for t in seg.lookback_bounds(AS_OF))
LOOKBACK_WHERE = (f"topic = 'log_nolabel' AND partition = 1 AND ts >= TIMESTAMP '{LO}' "
                  f"AND ts < TIMESTAMP '{HI}'")

CLICK_DAILY_SQL = f"""
SELECT strftime(ts, '%Y%m%d') AS date, product_name, product_volume,
  {age_click_sql('user_age')} AS user_age, user_gender,
  min(TRY_CAST(product_unitprice AS DOUBLE)) AS price_min, count(*) AS count
FROM logs WHERE {LOOKBACK_WHERE} AND key = 'click'
GROUP BY 1, 2, 3, 4, 5"""


@register("common_hourly", with_views(COMMON_HOURLY_SQL, "logs"))
def q_common_hourly(spark, d):
    return seg.common_hourly(fx.logs(spark, d, parts=False))


@register("search_daily", with_views(SEARCH_DAILY_SQL, "logs"))
def q_search_daily(spark, d):
    return seg.search_daily(fx.logs(spark, d, types=("view",)))


@register("click_daily", with_views(CLICK_DAILY_SQL, "logs"))
def q_click_daily(spark, d):
    return seg.click_daily(fx.logs(spark, d, types=("click",)), AS_OF)


@register("flatten_events", with_views(f"""
SELECT event_id, ts, CAST(hour(ts) AS INTEGER) AS hour, key,
  {age_hourly_sql('user_age')} AS user_age, user_gender, user_region, save_point,
  selected_menu, search_word, product_name
FROM logs""", "logs"))
def q_flatten_events(spark, d):
    return seg.flatten_events(fx.logs(spark, d), keep=("event_id",))


@register("search_events", with_views("""
SELECT ts, CASE WHEN user_gender = 'none' THEN 'un' ELSE user_gender END AS gender,
  """ + age_search_sql("user_age") + """ AS age, search_word AS word
FROM logs WHERE key = 'search'""", "logs"))
def q_search_events(spark, d):
    return seg.search_events(fx.logs(spark, d, types=("view",)))


@register("click_events", with_views("""
SELECT ts AS productclick_time, member_id, user_gender, user_age, user_region,
  product_name, product_volume, product_unitprice
FROM logs WHERE key = 'click'""", "logs"))
def q_click_events(spark, d):
    return seg.click_events(fx.logs(spark, d, types=("click",)))


@register("scan_partition", with_views("""
SELECT * FROM logs WHERE topic = 'log_nolabel' AND partition = 1""", "logs"))
def q_scan_partition(spark, d):
    return seg.scan_partition(fx.logs(spark, d, types=("click",)), "log_nolabel", 1)


@register("lookback_24h", with_views(f"SELECT * FROM logs WHERE {LOOKBACK_WHERE}", "logs"))
def q_lookback(spark, d):
    return seg.lookback(seg.scan_partition(fx.logs(spark, d), "log_nolabel", 1), AS_OF)


@register("age_band_hourly", with_views(f"""
SELECT event_id, user_age AS age_text, {age_hourly_sql('user_age')} AS age_band FROM logs""",
                                        "logs"))
def q_age_band_hourly(spark, d):
    return fx.logs(spark, d, parts=False).select("event_id", F.col("user_age").alias("age_text"),
                                    S.age_band_hourly("user_age").alias("age_band"))


@register("age_band_search", with_views(f"""
SELECT event_id, user_age AS age_text, {age_search_sql('user_age')} AS age_band FROM logs""",
                                        "logs"))
def q_age_band_search(spark, d):
    return fx.logs(spark, d, parts=False).select("event_id", F.col("user_age").alias("age_text"),
                                    S.age_band_search("user_age").alias("age_band"))


@register("age_band_click", with_views(f"""
SELECT event_id, user_age AS age_text, {age_click_sql('user_age')} AS age_band FROM logs""",
                                       "logs"))
def q_age_band_click(spark, d):
    return fx.logs(spark, d, parts=False).select("event_id", F.col("user_age").alias("age_text"),
                                    S.age_band_click("user_age").alias("age_band"))


@register("gender_norm", with_views("""
SELECT event_id, user_gender, CASE WHEN user_gender = 'none' THEN 'un' ELSE user_gender END
  AS gender FROM logs""", "logs"))
def q_gender_norm(spark, d):
    return fx.logs(spark, d, parts=False).select("event_id", "user_gender",
                                    S.gender_norm("user_gender").alias("gender"))


@register("price_parse", with_views("""
SELECT event_id, product_unitprice, TRY_CAST(product_unitprice AS DOUBLE) AS price
FROM logs WHERE key = 'click'""", "logs"))
def q_price_parse(spark, d):
    return fx.logs(spark, d, members=False, types=("click",)).filter(F.col("key") == "click").select(
        "event_id", "product_unitprice", S.parse_price("product_unitprice").alias("price"))


@register("route_events", with_views("""
SELECT event_id, key, topic, partition FROM logs""", "logs"))
def q_route_events(spark, d):
    return fx.logs(spark, d, members=False, parts=False).select("event_id", "key", S.route_topic("key").alias("topic"),
                                    S.route_partition("key").alias("partition"))
