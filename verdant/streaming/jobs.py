"""Structured Streaming forms of the jobs.

The streams run the same operators as the batch queries: decode the bus
record, flatten, aggregate by event-time window. What streaming adds is
only the source, a watermark, the output mode and the sink:

* S1/S2: a bus source (``kafka`` when its connector is on the classpath)
  or a file stand-in holding the same bus-record columns;
* W1-W3: 60-minute and 1440-minute windows, watermark as a parameter (the
  reference's hourly job had none, so its state never expired);
* W5-W8: update mode, ``foreachBatch`` into an idempotent keyed table, a
  mandatory checkpoint under the shared checkpoint folder;
* W11: the daily upload quota as keyed state with a one-day timeout.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from verdant.functions import scalars as S
from verdant.operators import points as pt
from verdant.operators import segments as seg
from verdant.session import stream_checkpoint
from verdant.sources import envelope as env
from verdant.sources import stored
from verdant.sources.sinks import KeyedTable
from verdant.streaming import member_sessions as ms

BUS_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])


def first_start(spark: SparkSession, folder: str) -> int:
    """The instant (microseconds) at which a job first began, kept in ``folder``
    beside its checkpoint, so that a restart goes on from there."""
    now = [(time.time_ns() // 1000,)]
    spark.createDataFrame(now, "micros bigint").coalesce(1).write.mode("ignore").json(folder)
    kept = spark.read.schema("micros bigint").json(folder).agg(F.min("micros").alias("micros")).first().micros
    if kept is None:
        raise ValueError(f"{folder} holds no start; it was left behind unfinished")
    return kept


def read_bus_stream(spark: SparkSession, topics: Sequence[str], path: str | None = None,
                    servers: str | None = None, starting: str = "earliest",
                    max_files_per_trigger: int | None = None,
                    start_folder: str | None = None) -> DataFrame:
    """Bus records of ``topics`` as a stream, from the ``earliest`` or the
    ``latest`` record on. With ``servers`` this is the bus connector; otherwise a
    folder of bus-record parquet files, of which ``latest`` leaves out those
    written before the job's first start. That start is kept in
    ``start_folder``, as the connector keeps its offsets in the checkpoint:
    what arrives while the job is down is read after a restart."""
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting is earliest or latest, not {starting}")
    if servers:
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("subscribe", ",".join(topics))
                .option("startingOffsets", starting).load())
    reader = spark.readStream.schema(BUS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = reader.parquet(path).filter(F.col("topic").isin(list(topics)))
    if starting == "latest":
        if not start_folder:
            raise ValueError("latest on a folder needs start_folder")
        # File times may be cut to whole milliseconds.
        since = first_start(spark, start_folder) // 1000 * 1000
        records = records.filter(F.unix_micros("_metadata.file_modification_time") >= since)
    return records


def decoded_logs(records: DataFrame, time_col: str = "event") -> DataFrame:
    """Bus records -> flat log rows with an event-time ``ts`` of timestamp type
    (watermarks need it). ``time_col``: ``event`` (envelope time, the search
    job) or ``bus`` (record time, the hourly job)."""
    flat = env.flatten_envelope(env.decoded_only(env.decode(records, keep=("timestamp",))),
                                keep=("timestamp",))
    t = F.col("ts") if time_col == "event" else F.col("timestamp")
    return flat.withColumn("ts", t.cast("timestamp")).drop("timestamp")


def hourly_stream(records: DataFrame, watermark: str = "1 hour",
                  time_col: str = "bus") -> DataFrame:
    """A1 as a stream: 60-minute windows per segment, update mode."""
    logs = decoded_logs(records, time_col).withWatermark("ts", watermark)
    return seg.with_day_hour(seg.common_hourly_windows(logs))


def search_stream(records: DataFrame, watermark: str = "30 seconds",
                  time_col: str = "event") -> DataFrame:
    """A2 as a stream: daily window counts of search words."""
    # The bus key tells searches apart before anything is decoded.
    key = F.col("key").cast("string")
    logs = decoded_logs(records.filter(key.isNull() | (key == "search")), time_col)
    searches = seg.search_events(logs).withWatermark("ts", watermark)
    agg = seg.search_daily_windows(searches)
    return agg.select(F.date_format("window.start", "yyyyMMdd").alias("date"),
                      "gender", "age", "word", F.col("count").cast("bigint").alias("count"))


def session_stream(records: DataFrame, watermark: str = "10 minutes",
                   time_col: str = "event") -> DataFrame:
    """W9 as a stream: sessions per member that end at a logout or after the gap
    (append mode: a session is emitted once it has ended). Events exactly one
    gap apart stay in one session, as in the batch form."""
    return ms.session_stream(decoded_logs(records, time_col), watermark)


def expired_stream(records: DataFrame, watermark: str = "10 minutes",
                   time_col: str = "event") -> DataFrame:
    """W10 as a stream: a synthetic logout for each session that ran out,
    emitted when the watermark passes its expiry."""
    return ms.expired_stream(decoded_logs(records, time_col), watermark)


def late_rows(query: StreamingQuery) -> DataFrame:
    """Per micro-batch, how many rows came after the watermark and were
    dropped. Read from the query's own progress records (the last
    ``spark.sql.streaming.numRecentProgressUpdates`` of them)."""
    rows = [(str(p["id"]), str(p["runId"]), int(p["batchId"]), str(p["eventTime"].get("watermark", "")),
             sum(int(o["numRowsDroppedByWatermark"]) for o in p["stateOperators"]))
            for p in query.recentProgress]
    return SparkSession.active().createDataFrame(
        rows, "query_id string, run_id string, batch_id bigint, watermark string, dropped bigint")


def start_keyed_upsert(agg: DataFrame, table: KeyedTable, name: str,
                       trigger: dict | None = None,
                       checkpoint: str | None = None) -> StreamingQuery:
    """W5-W8 + S10/S11: update-mode stream into a keyed table. The query's id
    lives in its checkpoint, so it names the writer: a restart goes on with
    the same generation, a new checkpoint opens the next one."""
    spark = agg.sparkSession

    def write(df: DataFrame, batch_id: int) -> None:
        writer = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.upsert(df, batch_id, writer)

    writer = (agg.writeStream.outputMode("update").queryName(name)
              .foreachBatch(write)
              .option("checkpointLocation", checkpoint or stream_checkpoint(spark, name)))
    writer = writer.trigger(**(trigger or {"processingTime": "5 minutes"}))
    return writer.start()


def start_ledger(records: DataFrame, path: str, name: str, trigger: dict | None = None,
                 checkpoint: str | None = None) -> StreamingQuery:
    """A19 as a stream: each micro-batch's points are added to the ledger at
    ``path`` once, also when the batch is run again after a failure; the query's
    id names the writer."""
    logs = decoded_logs(records)

    def write(df: DataFrame, batch_id: int) -> None:
        writer = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        stored.apply_points(df, path, batch_id, writer)

    writer = (logs.writeStream.queryName(name).foreachBatch(write)
              .option("checkpointLocation", checkpoint or stream_checkpoint(records.sparkSession, name)))
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


# ---------------------------------------------------------------------------
# Daily quota with keyed state and a one-day timeout
# ---------------------------------------------------------------------------
QUOTA_OUT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("member_id", T.LongType()),
    T.StructField("service", T.IntegerType()),
    T.StructField("verdict", T.StringType()),
])
QUOTA_STATE = T.StructType([
    T.StructField("count", T.IntegerType()),    # accepted uploads that day
    T.StructField("pic", T.LongType()),         # capture time of the last accepted, micros
])
STATE_TTL_MS = 86400 * 1000   # the cache entry lives one day after its last write


def quota_verdicts(rows: pd.DataFrame, service: int, count: int, last_pic: int | None) -> tuple[np.ndarray, int, int | None]:
    """Verdicts of one member's, service's and day's ordered rows, and the state after them.

    The state changes with an accepted upload alone, of which a day has at most
    the cap; between two of them all rows are decided at once."""
    cap, n = S.DAILY_CAP[service], len(rows)
    pre, post = rows["pre_code"].to_numpy(object), rows["post_code"].to_numpy(object)
    coded, failed = ~pd.isna(pre), ~pd.isna(post)
    pic = rows["pic_time"].to_numpy("datetime64[us]").view("int64")     # a missing time is the least number
    missing = np.iinfo("int64").min
    verdict = np.where(coded, pre, np.where(failed, post, pt.ACCEPTED)).astype(object)
    at = 0
    while at < n:
        rest = slice(at, n)
        free = ~coded[rest]
        last = missing if last_pic is None else last_pic
        repeat = free & (pic[rest] == last) if service == 1 and count == 1 else np.zeros(n - at, bool)
        over = free & ~repeat if count >= cap else np.zeros(n - at, bool)
        accepted = np.flatnonzero(free & ~repeat & ~over & ~failed[rest])
        end = n if not len(accepted) else at + int(accepted[0])
        verdict[at:end][repeat[:end - at]] = "ImgDuplicated"
        verdict[at:end][over[:end - at]] = "OverCount"
        if end < n:
            count, last_pic = count + 1, None if pic[end] == missing else int(pic[end])
        at = end + 1
    return verdict, count, last_pic


def _quota(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One member, service and day, in event-time order within the micro-batch.
    Rows of the stream arrive in event-time order per member, as the requests did."""
    if state.hasTimedOut:
        state.remove()
        return
    count, last_pic = state.get if state.exists else (0, None)
    pdf = pd.concat(list(frames), ignore_index=True).sort_values(["ts", "event_id"])
    verdict, count, last_pic = quota_verdicts(pdf, int(key[1]), count, last_pic)
    state.update((count, last_pic))
    last_ms = int(pd.Timestamp(pdf["ts"].max()).value // 10**6)
    state.setTimeoutTimestamp(max(last_ms + STATE_TTL_MS, state.getCurrentWatermarkMs() + 1))
    yield pdf[["event_id", "member_id", "service"]].assign(verdict=verdict)


def quota_stream(uploads: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Upload verdicts of a stream of service-1 uploads (R1 with W11 state).
    The stateless codes are plain columns; only the per-member history runs
    in Python, one small state row per (member, service, day), so a busy
    member's days lie in different groups; an event-time timeout drops it one
    day after its last write."""
    coded = uploads.withWatermark("ts", watermark).select(
        "event_id", "member_id", "service", "ts", "day", "pic_time",
        pt.upload_pre().alias("pre_code"), pt.upload_post().alias("post_code"))
    return coded.groupBy("member_id", "service", "day").applyInPandasWithState(
        _quota, QUOTA_OUT, QUOTA_STATE, "append", GroupStateTimeout.EventTimeTimeout)
