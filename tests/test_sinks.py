"""Sinks: bus stand-in, CSV export, archive, idempotent keyed table."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from verdant.operators import segments as seg
from verdant.sources import envelope as env
from verdant.sources import fixtures as fx
from verdant.sources import sinks


def test_bus_sink_pins_partition(spark, scratch):
    clicks = seg.click_daily(fx.logs(spark, SF_SMALL), fx.LOGS_AS_OF)
    path = os.path.join(scratch, "bus")
    sinks.write_bus(env.click_payload(clicks), "log_aggregation", path=path, partition=0)
    back = spark.read.json(path)
    assert back.count() == clicks.count()
    assert {r.partition for r in back.select("partition").distinct().collect()} == {0}


def test_csv_export_and_archive(spark, scratch):
    logs = fx.logs(spark, SF_SMALL)
    sinks.export_csv(logs.select("event_id", "key"), os.path.join(scratch, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(scratch, "csv"))
    assert back.count() == logs.count()
    sinks.archive_events(logs.select("event_id", "ts", "key"), os.path.join(scratch, "arch"))
    arch = spark.read.option("header", True).csv(os.path.join(scratch, "arch"))
    assert arch.count() == logs.count()
    assert arch.select("date").distinct().count() == logs.select(F.to_date("ts")).distinct().count()


def test_keyed_table_is_idempotent_and_last_write_wins(spark, scratch):
    t = sinks.KeyedTable(spark, os.path.join(scratch, "kt"), ["date", "k"])
    b0 = spark.createDataFrame([("20240101", "a", 1), ("20240101", "b", 2)], "date string, k string, v bigint")
    b1 = spark.createDataFrame([("20240101", "a", 5)], "date string, k string, v bigint")
    t.upsert(b0, 0)
    t.upsert(b1, 1)
    first = {(r.k, r.v) for r in t.read().collect()}
    t.upsert(b1, 1)   # replay of batch 1
    assert {(r.k, r.v) for r in t.read().collect()} == first == {("a", 5), ("b", 2)}
    assert t.read("20240101").count() == 2 and t.read("20240102").count() == 0


def test_keyed_table_compaction_and_partition_pruning(spark, scratch):
    t = sinks.KeyedTable(spark, os.path.join(scratch, "kt"), ["date", "k"])
    for i, v in enumerate((1, 2, 3)):
        t.upsert(spark.createDataFrame([("20240101", "a", v), ("20240102", "b", 10 * v)],
                                       "date string, k string, v bigint"), i)
    latest = {(r.date, r.k, r.v) for r in t.read().collect()}
    assert latest == {("20240101", "a", 3), ("20240102", "b", 30)}
    target = os.path.join(scratch, "compact")
    t.compact(target)
    c = sinks.KeyedTable(spark, target, ["date", "k"])
    assert c.raw().count() == 2
    assert {(r.date, r.k, r.v) for r in c.read().collect()} == latest
    # a day read touches only that day's folders
    plan = t.read("20240101")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "20240101" in plan


def test_keyed_table_keeps_rows_when_writers_change(spark, scratch):
    def batch(*rows):
        return spark.createDataFrame(list(rows), "date string, k string, v bigint")

    day = "20240101"
    t = sinks.KeyedTable(spark, os.path.join(scratch, "kt"), ["date", "k"])
    t.upsert(batch((day, "a", 1), (day, "b", 2)), 0, "w1")
    t.upsert(batch((day, "a", 5)), 1, "w1")
    t.upsert(batch((day, "a", 100)), 0, "w2")     # a new writer starts at batch 0
    want = {("a", 100), ("b", 2)}
    assert {(r.k, r.v) for r in t.read().collect()} == want
    target = os.path.join(scratch, "compact")
    t.compact(target)
    c = sinks.KeyedTable(spark, target, ["date", "k"])
    assert {(r.k, r.v) for r in c.read().collect()} == want
    c.upsert(batch((day, "c", 7)), 0, "w3")       # after compaction, too
    c.upsert(batch((day, "a", 101)), 1, "w2")     # and for a writer that goes on
    assert {(r.k, r.v) for r in c.read().collect()} == {("a", 101), ("b", 2), ("c", 7)}
    assert c.generation("w1") == 0 and c.generation("w3") == 2
