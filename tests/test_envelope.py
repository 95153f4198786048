"""Envelope decode/encode (S5-S8) including the malformed rows of K11."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from verdant.sources import envelope as env
from verdant.sources import fixtures as fx


def test_round_trip_is_identity(spark):
    logs = fx.logs(spark, SF_SMALL)
    rec = env.to_binary_record(env.encode_envelope(logs, keep=("event_id",)))
    back = env.flatten_envelope(env.decode(rec, keep=("event_id",)), keep=("event_id",))
    cols = ["event_id", "key", *env.ENCODED_PAYLOAD]
    a = logs.select(*cols, F.date_trunc("millisecond", "ts").alias("ts"))
    b = back.select(*cols, "ts")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bad_rows_go_to_quarantine(spark):
    good = ('{"messageType":"Kafka","timestamp":"2024-01-15T10:00:00.000Z",'
            '"fields":{"event":"UserLogin","topic":"log_inout","key":"login",'
            '"fields":{"member_id":"7","save_point":10}}}')
    wrong_type = good.replace('"save_point":10', '"save_point":"10"')
    rows = [("login", good), ("x", "not json"), ("y", '{"messageType":"Kafka"}'),
            ("login", wrong_type)]
    rec = spark.createDataFrame(rows, "key string, value string")
    dec = env.decode(rec)
    assert dec.transform(env.quarantine).count() == 2
    flat = env.flatten_envelope(env.decoded_only(dec)).collect()
    assert len(flat) == 2
    pts = sorted((r.save_point is None) for r in flat)
    assert pts == [False, True]   # text "10" for an int field is null on its own
    assert {r.member_id for r in flat} == {"7"}


def test_click_payload_writes_nulls(spark):
    df = spark.createDataFrame([("a", None)], "p string, price_min double")
    assert env.click_payload(df).first().value == '{"p":"a","price_min":null}'


def test_producer_offset_shifts_time(spark):
    logs = fx.logs(spark, SF_SMALL).limit(1)
    v0 = env.encode_envelope(logs).first().value
    v9 = env.encode_envelope(logs, offset_hours=9).first().value
    assert v0 != v9 and '"messageType":"Kafka"' in v9
