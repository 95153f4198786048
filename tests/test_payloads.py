"""Every field that an event writes survives the bus record; the rest is absent."""

from __future__ import annotations

import json

from conftest import SF_SMALL
from pyspark.sql import functions as F

from verdant.sources import envelope as env
from verdant.sources import fixtures as fx
from verdant.sources import payloads as pl


def test_every_field_comes_back(spark):
    events = fx.payload_logs(spark, SF_SMALL)
    records = env.to_binary_record(pl.encode_payloads(events, keep=("event_id",)))
    back = {r.event_id: r for r in pl.payload_columns(pl.parse_records(records, ("event_id",)), ("event_id",)).collect()}
    seen = set()
    for r in events.collect():
        if r.key is None:
            assert r.event_id not in back
            continue
        own = pl.MEMBER_FIELDS + pl.EVENT_FIELDS[r.key]
        for f in pl.ALL_FIELDS:
            assert back[r.event_id][f] == (r[f] if f in own else None)
            if f in own and r[f] is not None:
                seen.add(f)
        assert back[r.event_id].event == env.EVENT_BY_KEY[r.key]
    assert seen == set(pl.ALL_FIELDS)


def test_record_holds_its_event_only(spark):
    for r in pl.encode_payloads(fx.payload_logs(spark, SF_SMALL)).limit(300).collect():
        if r.key is not None:
            fields = json.loads(r.value)["fields"]["fields"]
            assert set(fields) == set(pl.MEMBER_FIELDS + pl.EVENT_FIELDS[r.key])


def test_broken_records(spark):
    good = '{"messageType":"Kafka","timestamp":"2024-01-03T10:00:00.000Z","fields":{"event":"UserLogin","topic":"log_inout",' \
           '"key":"login","fields":{"member_id":"7","save_point":"many","radius_km":3,"login_time":null,"new":[1]}}}'
    values = [good, "not json", "", None, "[]", '{"fields":{"key":null}}', '{"fields":5}', good.replace('"key":"login"', '"key":"other"')]
    parsed = pl.parse_records(spark.createDataFrame([(v,) for v in values], "value string").withColumn("value", F.col("value").cast("binary")))
    assert pl.unplaced(parsed).count() == 6
    rows = pl.payload_columns(parsed).collect()
    assert [r.key for r in rows] == ["login", "other"]
    assert (rows[0].member_id, rows[0].save_point, rows[0].radius_km, rows[0].login_time) == ("7", None, 3, None)


def test_only_what_is_asked_for(spark):
    parsed = pl.parse_records(pl.encode_payloads(fx.payload_logs(spark, SF_SMALL)))
    assert pl.payload_columns(parsed, fields=["radius_km"]).columns == ["ts", "key", "topic", "event", "radius_km"]
