"""Start offsets of the folder form of the bus."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from verdant.streaming import jobs


def _send(spark, path, *values):
    rows = [(b"search", v.encode(), "log_nolabel", 0) for v in values]
    spark.createDataFrame(rows, "key binary, value binary, topic string, partition int") \
        .withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")) \
        .coalesce(1).write.mode("append").parquet(path)


def _drain(spark, scratch, starting, name):
    """Run the stream over what is there now; all values it has ever given."""
    out = os.path.join(scratch, "out-" + name)
    records = jobs.read_bus_stream(spark, ["log_nolabel"], path=os.path.join(scratch, "bus"), starting=starting,
                                   start_folder=os.path.join(scratch, "start-" + name))
    q = records.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", os.path.join(scratch, "check-" + name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return sorted(bytes(r.value).decode() for r in spark.read.schema(jobs.BUS_SCHEMA).parquet(out).collect())


def test_latest_leaves_out_earlier_files_and_goes_on_after_a_restart(spark, scratch):
    bus = os.path.join(scratch, "bus")
    _send(spark, bus, "old")
    time.sleep(0.05)
    assert _drain(spark, scratch, "latest", "l") == []
    _send(spark, bus, "new")
    assert _drain(spark, scratch, "latest", "l") == ["new"]
    _send(spark, bus, "while down", "also")
    assert _drain(spark, scratch, "latest", "l") == ["also", "new", "while down"]
    assert _drain(spark, scratch, "earliest", "e") == ["also", "new", "old", "while down"]


def test_start_is_one_of_two_and_latest_needs_a_folder(spark, scratch):
    with pytest.raises(ValueError):
        jobs.read_bus_stream(spark, ["t"], path=scratch, starting="yesterday")
    with pytest.raises(ValueError):
        jobs.read_bus_stream(spark, ["t"], path=scratch, starting="latest")
