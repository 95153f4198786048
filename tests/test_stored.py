"""Ledger batches, warm tier, bus archive, serving table: replays and pruning."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F
from test_streaming import _bus_files

from verdant.operators import points as pt
from verdant.operators import segments as seg
from verdant.sources import fixtures as fx
from verdant.sources import stored as st
from verdant.streaming import jobs

ROW = "ts timestamp, key string, member_id string, save_point int"


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _explain(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _points(spark, *rows):
    return spark.createDataFrame([("2024-01-0%d 10:00:00" % d, k, m, p) for d, k, m, p in rows],
                                 ROW.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp"))


def test_ledger_counts_each_batch_once(spark, scratch):
    path = os.path.join(scratch, "ledger")
    first = _points(spark, (1, "1", "a", 10), (2, "2", "b", 20), (2, "login", "b", None), (3, "1", "none", 50))
    second = _points(spark, (4, "1", "a", 5), (4, "1", "c", 0))
    for n, rows in ((0, first), (1, second), (1, second), (0, first)):
        st.apply_points(rows, path, n)
    want = [("a", "2024-01", 15), ("b", "2024-01", 20), ("c", "2024-01", 0)]
    assert _rows(st.read_ledger(spark, path)) == want
    # Folding changes nothing, nor does a folded batch that is applied again.
    st.fold_ledger(spark, path, "direct", 0)
    assert _rows(st.read_ledger(spark, path)) == want
    st.apply_points(first, path, 0)
    st.fold_ledger(spark, path, "direct", 0)
    assert _rows(st.read_ledger(spark, path)) == want
    st.fold_ledger(spark, path, "direct", 1)
    st.apply_points(second, path, 2)
    assert _rows(st.read_ledger(spark, path)) == [("a", "2024-01", 20), *want[1:]]
    # Another writer counts its batches from 0 and adds up.
    st.apply_points(first, path, 0, writer="other")
    assert _rows(st.read_ledger(spark, path)) == [("a", "2024-01", 30), ("b", "2024-01", 40), ("c", "2024-01", 0)]


def test_unfinished_fold_is_not_read(spark, scratch):
    path = os.path.join(scratch, "ledger")
    st.apply_points(_points(spark, (1, "1", "a", 10)), path, 0)
    st.fold_ledger(spark, path, "direct", 0)
    os.remove(f"{path}/folded/writer=direct/upto=0/_SUCCESS")
    assert _rows(st.read_ledger(spark, path)) == [("a", "2024-01", 10)]


def test_empty_ledger(spark, scratch):
    assert st.read_ledger(spark, os.path.join(scratch, "none")).collect() == []
    path = os.path.join(scratch, "ledger")
    st.apply_points(_points(spark, (1, "login", "a", None)), path, 0)
    assert st.read_ledger(spark, path).collect() == []


def test_ledger_stream_equals_batch(spark, scratch):
    logs = fx.logs(spark, SF_SMALL)
    src, path, check = (os.path.join(scratch, x) for x in ("bus", "ledger", "check"))
    _bus_files(spark, logs, src)
    records = jobs.read_bus_stream(spark, ["log_ecopoint"], path=src, max_files_per_trigger=1)
    for _ in range(2):              # the second run finds nothing new
        jobs.start_ledger(records, path, "ledger_test", {"availableNow": True}, check).awaitTermination(300)
    want = _rows(pt.points_ledger(logs))
    assert _rows(st.read_ledger(spark, path)) == want and len(want) > 10
    writer = next(f for f in os.listdir(f"{path}/batches")).split("=")[1]
    st.fold_ledger(spark, path, writer, 1)
    assert _rows(st.read_ledger(spark, path)) == want


def test_warm_tier_keeps_seven_days(spark, scratch):
    path = os.path.join(scratch, "warm")
    hourly = seg.common_hourly(fx.logs(spark, SF_SMALL, parts=False)).cache()
    days = [f"202401{d:02d}" for d in range(8, 17)]
    for day in days:
        st.append_warm(hourly.filter(F.col("date") == day), path, day)
        stored = sorted(f.split("=")[1] for f in os.listdir(path) if f.startswith("date="))
        assert stored == [x for x in days if x <= day][-7:]
    want = _rows(hourly.filter(F.col("date").between("20240110", "20240116")).select(sorted(hourly.columns)))
    for _ in range(2):
        assert _rows(st.read_days(spark, path, hourly.schema).select(sorted(hourly.columns))) == want
        st.append_warm(hourly.filter(F.col("date") == "20240116"), path, "20240116")    # a re-run changes nothing
    hourly.unpersist()


def test_bus_scan_opens_one_partition(spark, scratch):
    path = os.path.join(scratch, "bus")
    records = fx.logs(spark, SF_SMALL, members=False, parts=False).withColumn("timestamp", F.col("ts")) \
        .select("event_id", "key", "topic", "partition", "timestamp")
    for _ in range(2):
        st.archive_bus(records, path)
    schema = records.withColumn("date", F.lit("")).schema
    got = st.scan_bus(spark, path, schema, "log_nolabel", 1, ("20240110", "20240112"))
    plan = _explain(got)
    filters = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert all(name in filters for name in ("topic", "partition", "date"))
    files = [r[0] for r in got.select("_metadata.file_path").distinct().collect()]
    assert files and all("topic=log_nolabel/partition=1/date=2024011" in f for f in files)
    want = records.filter("topic = 'log_nolabel' AND partition = 1 AND timestamp >= '2024-01-10' AND timestamp < '2024-01-13'")
    assert _rows(got.select("event_id")) == _rows(want.select("event_id")) != []


def test_serving_table_is_sorted_and_skips(spark, scratch):
    path = os.path.join(scratch, "serving")
    hourly = seg.common_hourly(fx.logs(spark, SF_MID, parts=False)).cache()
    st.store_serving(hourly, path, rows_per_group=20)
    got = st.serve_segment(spark, path, hourly.schema, "20240115", 30)
    rows = got.select("user_gender", "user_region", "hour").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows) and rows
    assert got.count() == hourly.filter("date = '20240115' AND user_age = 30").count()
    plan = _explain(got)
    assert "EqualTo(user_age,30)" in plan and "date" in next(x for x in plan.splitlines() if x.startswith("PartitionFilters"))
    groups = hold = 0
    folder = f"{path}/date=20240115"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{folder}/{name}").metadata
            column = meta.schema.names.index("user_age")
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(column).statistics
                groups, hold = groups + 1, hold + (s is None or not s.has_min_max or s.min <= 30 <= s.max)
    assert groups >= 4 and hold <= groups / 2
    hourly.unpersist()
