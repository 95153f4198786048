"""Queries: per-event payloads, the ledger batch by batch, the warm tier, the bus
archive and the serving table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from verdant.operators import keyed as kt
from verdant.operators import segments as seg
from verdant.plans.q_keyed import EVENT_CASE
from verdant.plans.q_segments import COMMON_HOURLY_SQL
from verdant.plans.q_sessions import METRICS_SQL
from verdant.plans.registry import register
from verdant.plans.sql_views import with_views
from verdant.session import checkpoint_dir
from verdant.sources import envelope as env
from verdant.sources import fixtures as fx
from verdant.sources import payloads as pl
from verdant.sources import stored as st

DAY = fx.DASHBOARD_DAY


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# payloads
# ---------------------------------------------------------------------------
def _object(fields: list[str]) -> str:
    """A VARIANT object writes its fields by name."""
    return "to_json({" + ", ".join(f"'{f}': {f}" for f in sorted(fields)) + "})"


PAYLOAD_CASE = "CASE key " + " ".join(
    f"WHEN '{k}' THEN {_object(pl.MEMBER_FIELDS + fields)}" for k, fields in pl.EVENT_FIELDS.items()) + " END"
ENCODED_SQL = f"""
SELECT event_id, key,
  CAST(to_json({{'messageType': 'Kafka', 'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ'),
                 'fields': {{'event': {EVENT_CASE}, 'topic': topic, 'key': key, 'fields': {PAYLOAD_CASE}}}}}) AS VARCHAR) AS value,
  topic, partition, ts AS timestamp
FROM plogs"""


@register("encode_payload", with_views(ENCODED_SQL, "plogs"))
def q_encode_payload(spark, d):
    return pl.encode_payloads(fx.payload_logs(spark, d), keep=("event_id",))


PLAIN = [f for f in pl.ALL_FIELDS if f not in pl.FIELD_TYPES]


def _text(path: str) -> str:
    return f"json_extract_string(value, '$.{path}')"


@register("decode_payload", with_views(f"""
SELECT event_id, strptime({_text('timestamp')}, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts, {_text('fields.key')} AS key,
  {_text('fields.topic')} AS topic, {_text('fields.event')} AS event,
  {', '.join(f"{_text('fields.fields.' + f)} AS {f}" for f in PLAIN)},
  TRY_CAST({_text('fields.fields.save_point')} AS INTEGER) AS save_point,
  TRY_CAST({_text('fields.fields.radius_km')} AS INTEGER) AS radius_km,
  CAST({_text('fields.fields.searchclick_location[0]')} AS DOUBLE) AS lat,
  CAST({_text('fields.fields.searchclick_location[1]')} AS DOUBLE) AS lng
FROM encoded WHERE {_text('fields.key')} IS NOT NULL""", "plogs", extra={"encoded": ENCODED_SQL}))
def q_decode_payload(spark, d):
    records = env.to_binary_record(pl.encode_payloads(fx.payload_logs(spark, d), keep=("event_id",)))
    rows = pl.payload_columns(pl.parse_records(records, keep=("event_id",)), keep=("event_id",))
    at = F.col("searchclick_location")
    return rows.select("event_id", "ts", "key", "topic", "event", *PLAIN, "save_point", "radius_km",
                       F.get(at, 0).alias("lat"), F.get(at, 1).alias("lng"))


# ---------------------------------------------------------------------------
# Two batches, the second applied twice, the first folded
# ---------------------------------------------------------------------------
@register("ledger_batches", with_views("""
SELECT member_id, strftime(ts, '%Y-%m') AS month_kb, CAST(sum(save_point) AS BIGINT) AS point_amt
FROM logs WHERE key IN ('1', '2') AND member_id <> 'none' GROUP BY 1, 2""", "logs"))
def q_ledger_batches(spark, d):
    path, logs = _folder(spark, "ledger"), fx.logs(spark, d, parts=False, types=("purchase",))
    early = F.col("ts") < kt.day_range(DAY)[0]
    st.apply_points(logs.filter(early), path, 0)
    for _ in range(2):
        st.apply_points(logs.filter(~early), path, 1)
    st.fold_ledger(spark, path, "direct", 0)
    return st.read_ledger(spark, path)


# ---------------------------------------------------------------------------
# Nine days stored one after the other, seven kept
# ---------------------------------------------------------------------------
@register("warm_tier", with_views(f"""
SELECT date, user_age, user_region, user_gender, {METRICS_SQL} FROM hourly
WHERE date BETWEEN strftime(strptime('{DAY}', '%Y%m%d') - INTERVAL 6 DAY, '%Y%m%d') AND '{DAY}'
GROUP BY 1, 2, 3, 4""", "logs", extra={"hourly": COMMON_HOURLY_SQL}))
def q_warm_tier(spark, d):
    path = _folder(spark, "warm")
    start, end = kt.day_range(DAY)
    logs = fx.logs(spark, d, parts=False)

    def hourly(lo, hi):
        return seg.common_hourly(logs.filter((F.col("ts") >= lo) & (F.col("ts") < hi)))

    before = hourly(start - F.make_dt_interval(days=F.lit(8)), start)
    st.append_warm(before, path, spark.range(1).select(F.date_format(start - F.make_dt_interval(days=F.lit(1)), "yyyyMMdd")).first()[0])
    st.append_warm(hourly(start, end), path, DAY)
    week = st.read_days(spark, path, before.schema)
    return week.groupBy("date", "user_age", "user_region", "user_gender").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in seg.METRIC_NAMES])


# ---------------------------------------------------------------------------
# One partition of a topic, the days of the 24 hours before AS_OF - 5 h
# ---------------------------------------------------------------------------
BUS_LO, BUS_HI = seg.lookback_bounds(fx.LOGS_AS_OF)
BUS_COLUMNS = ["event_id", "key", "topic", "partition", "timestamp", "product_name", "product_unitprice"]


@register("scan_bus_partition", with_views(f"""
SELECT event_id, key, topic, partition, ts AS timestamp, product_name, product_unitprice, strftime(ts, '%Y%m%d') AS date
FROM logs WHERE topic = 'log_nolabel' AND partition = 1
  AND ts >= TIMESTAMP '{BUS_LO}' AND ts < TIMESTAMP '{BUS_HI}'""", "logs"))
def q_scan_bus_partition(spark, d):
    path = _folder(spark, "bus")
    records = fx.logs(spark, d, members=False).withColumn("timestamp", F.col("ts")).select(*BUS_COLUMNS)
    records = records.filter(F.col("topic").isNotNull())
    st.archive_bus(records, path)
    found = st.scan_bus(spark, path, records.withColumn("date", F.lit("")).schema, "log_nolabel", 1,
                        (BUS_LO.strftime("%Y%m%d"), BUS_HI.strftime("%Y%m%d")))
    return seg.lookback(found, fx.LOGS_AS_OF, time_col="timestamp")


# ---------------------------------------------------------------------------
# O2: the hourly table of one day and age band, sorted
# ---------------------------------------------------------------------------
SERVED_AGE = 30


@register("serve_segment", with_views(
    f"SELECT * FROM hourly WHERE date = '{DAY}' AND user_age = {SERVED_AGE} ORDER BY user_age, user_gender, user_region, hour",
    "logs", extra={"hourly": COMMON_HOURLY_SQL}))
def q_serve_segment(spark, d):
    path = _folder(spark, "serving")
    hourly = seg.common_hourly(fx.logs(spark, d, parts=False))
    st.store_serving(hourly, path)
    return st.serve_segment(spark, path, hourly.schema, DAY, SERVED_AGE)
