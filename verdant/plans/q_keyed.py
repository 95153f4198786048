"""Queries: envelope round trip, payload rules, keyed-table reads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.operators import keyed as kt
from verdant.operators import segments as seg
from verdant.plans.q_segments import CLICK_DAILY_SQL, COMMON_HOURLY_SQL, SEARCH_DAILY_SQL
from verdant.plans.registry import register
from verdant.plans.sql_views import with_views
from verdant.sources import envelope as env
from verdant.session import checkpoint_dir
from verdant.sources import fixtures as fx

DAY = fx.DASHBOARD_DAY

EVENT_CASE = "CASE key " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in env.EVENT_BY_KEY.items()) + " END"
PAYLOAD_SQL = ", ".join(f"'{c}': {c}" for c in env.ENCODED_PAYLOAD)
ENCODED_SQL = f"""
SELECT event_id, key,
  CAST(to_json({{'messageType': 'Kafka',
                 'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ'),
                 'fields': {{'event': {EVENT_CASE}, 'topic': topic, 'key': key,
                            'fields': {{{PAYLOAD_SQL}}}}}}}) AS VARCHAR) AS value,
  topic, partition, ts AS timestamp
FROM logs"""


@register("encode_envelope", with_views(ENCODED_SQL, "logs"))
def q_encode_envelope(spark, d):
    return env.encode_envelope(fx.logs(spark, d), keep=("event_id",))


# The producers write epoch time + 9 h.
@register("wall_time", with_views("""
SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%gZ') AS wall_time
FROM logs""", "logs"))
def q_wall_time(spark, d):
    logs = fx.logs(spark, d, members=False, parts=False)
    return logs.select("event_id", S.wall_time_text("ts").alias("wall_time"))


@register("simple_values", with_views("""
SELECT event_id, CAST(day AS VARCHAR) AS day, CAST(pic_time AS VARCHAR) AS pic_time,
  size_bytes, model_ok FROM uploads""", "uploads"))
def q_simple_values(spark, d):
    return env.simple_values(fx.uploads(spark, d).select("event_id", "day", "pic_time",
                                                         "size_bytes", "model_ok"))


def _json(path: str) -> str:
    return f"json_extract_string(value, '$.{path}')"


DECODE_SQL = f"""
SELECT event_id,
  strptime({_json('timestamp')}, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts,
  {_json('fields.key')} AS key, {_json('fields.topic')} AS topic,
  {_json('fields.event')} AS event,
  """ + ",\n  ".join(
    (f"TRY_CAST({_json('fields.fields.' + c)} AS INTEGER) AS {c}" if c == "save_point"
     else f"{_json('fields.fields.' + c)} AS {c}") for c in env.ENCODED_PAYLOAD) + """
FROM encoded"""


@register("decode_envelope", with_views(DECODE_SQL, "logs", extra={"encoded": ENCODED_SQL}))
def q_decode_envelope(spark, d):
    records = env.to_binary_record(env.encode_envelope(fx.logs(spark, d), keep=("event_id",)))
    return env.flatten_envelope(env.decode(records, keep=("event_id",)), keep=("event_id",))


CLICK_COLS = ["date", "product_name", "product_volume", "user_age", "user_gender",
              "price_min", "count"]


@register("click_payload", with_views(
    "SELECT CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in CLICK_COLS) + "}) AS VARCHAR)"
    " AS value FROM clicks", "logs", extra={"clicks": CLICK_DAILY_SQL}))
def q_click_payload(spark, d):
    return env.click_payload(seg.click_daily(fx.logs(spark, d, types=("click",)), fx.LOGS_AS_OF, sort=False))


REDACT_INPUT = ["member_id", "user_gender", "user_age", "user_region", "topic", "key",
                "selected_menu", "search_word", "product_name"]
SKIP_SQL = ", ".join(f"'{s}'" for s in dict.fromkeys(S.PAYLOAD_SKIP_FIELDS))


@register("redact_fields", with_views(f"""
SELECT event_id, field, value FROM (
  UNPIVOT (SELECT event_id, {', '.join(REDACT_INPUT)} FROM logs)
  ON {', '.join(REDACT_INPUT)} INTO NAME field VALUE value)
WHERE field NOT IN ({SKIP_SQL})""", "logs"))
def q_redact_fields(spark, d):
    logs = fx.logs(spark, d)
    payload = F.create_map(*[x for c in REDACT_INPUT for x in (F.lit(c), F.col(c))])
    fields = env.payload_fields(logs.select("event_id", payload.alias("payload")), "payload",
                                keep=("event_id",))
    return fields.filter(F.col("value").isNotNull())


@register("union_topics", with_views("\nUNION ALL BY NAME\n".join(
    f"SELECT {', '.join(kt.COMMON_COLUMNS + cols)}, '{t}' AS topic FROM logs WHERE topic = '{t}'"
    for t, cols in kt.TOPIC_COLUMNS.items()), "logs"))
def q_union_topics(spark, d):
    return kt.select_topics(fx.logs(spark, d))


@register("kv_latest", with_views("""
SELECT member_id, key, topic, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM logs) WHERE rn = 1""", "logs"))
def q_kv_latest(spark, d):
    return kt.latest_by_key(fx.logs(spark, d, parts=False), ["member_id"], ["ts", "event_id"],
                            ["key", "topic"])


COMMON_KEY_SQL = """concat_ws(':', date, CAST(hour AS VARCHAR), coalesce(user_gender, 'none'),
  coalesce(CAST(user_age AS VARCHAR), 'none'), coalesce(user_region, 'none'))"""


@register("common_key", with_views(f"SELECT *, {COMMON_KEY_SQL} AS key FROM hourly", "logs",
                                   extra={"hourly": COMMON_HOURLY_SQL}))
def q_common_key(spark, d):
    return kt.with_key(seg.common_hourly(fx.logs(spark, d, parts=False)), kt.COMMON_KEY_PARTS)


@register("search_key", with_views("""
SELECT *, concat_ws(':', date, coalesce(gender, 'none'), coalesce(CAST(age AS VARCHAR), 'none'),
  coalesce(word, 'none')) AS key FROM search""", "logs", extra={"search": SEARCH_DAILY_SQL}))
def q_search_key(spark, d):
    return kt.with_key(seg.search_daily(fx.logs(spark, d, types=("view",))), kt.SEARCH_KEY_PARTS)


@register("window_day_text", with_views("""
SELECT DISTINCT date_trunc('hour', ts) AS window_start, strftime(ts, '%Y%m%d') AS date_text
FROM logs"""
                                        , "logs"))
def q_window_day_text(spark, d):
    w = fx.logs(spark, d, members=False, parts=False).select(F.window("ts", "60 minutes").alias("window")).distinct()
    return w.select(F.col("window.start").alias("window_start"),
                    S.window_day_text("window").alias("date_text"))


SPLIT_SQL = f"""
SELECT key, split_part(key, ':', 1) AS date, split_part(key, ':', 2) AS hour,
  split_part(key, ':', 3) AS user_gender, split_part(key, ':', 4) AS user_age,
  array_to_string(string_split(key, ':')[5:], ':') AS user_region
FROM (SELECT {COMMON_KEY_SQL} AS key FROM hourly)"""


def _split(spark, d):
    keys = kt.with_key(seg.common_hourly(fx.logs(spark, d, parts=False)), kt.COMMON_KEY_PARTS).select("key")
    return kt.split_keys(keys, kt.COMMON_KEY_PARTS)


@register("split_key", with_views(SPLIT_SQL, "logs", extra={"hourly": COMMON_HOURLY_SQL}))
def q_split_key(spark, d):
    return _split(spark, d)


@register("coerce_numeric", with_views("""
SELECT key, CAST(date AS BIGINT) AS date, CAST(hour AS BIGINT) AS hour, user_gender,
  CAST(user_age AS BIGINT) AS user_age, user_region FROM parts""", "logs",
                                       extra={"hourly": COMMON_HOURLY_SQL, "parts": SPLIT_SQL}))
def q_coerce_numeric(spark, d):
    return kt.coerce_numeric(_split(spark, d))


def _stored(spark, rows, name: str):
    """``rows`` as a stored table of their own in the shared folder, one folder per day."""
    path = f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    rows.hint("rebalance", "date").write.partitionBy("date").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)   # the day key stays text


@register("scan_common_day", with_views(f"SELECT * FROM hourly WHERE date = '{DAY}'", "logs",
                                        extra={"hourly": COMMON_HOURLY_SQL}))
def q_scan_common_day(spark, d):
    hourly = seg.common_hourly(fx.logs(spark, d, parts=False))
    return _stored(spark, hourly, "common").filter(F.col("date") == DAY)


@register("scan_search_day", with_views(f"SELECT * FROM search WHERE date = '{DAY}'", "logs",
                                        extra={"search": SEARCH_DAILY_SQL}))
def q_scan_search_day(spark, d):
    search = seg.search_daily(fx.logs(spark, d, types=("view",)))
    return _stored(spark, search, "search").filter(F.col("date") == DAY)
