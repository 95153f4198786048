"""Sessions in a stream: they end at a logout or run out, as in the batch form."""

from __future__ import annotations

import datetime as dt
import os
import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_streaming import LOG_SCHEMA, _append_in_order, _bus_files

from verdant.operators import sessions as ss
from verdant.sources import envelope as env
from verdant.sources import fixtures as fx
from verdant.streaming import jobs
from verdant.streaming import member_sessions as ms

TOPICS = ["log_inout", "log_menuclick", "log_ecopoint", "log_lesswaste", "log_nolabel"]
GAP = 1800 * 1_000_000
COLUMNS = ["member_id", "session_start", "session_end", "expires_at", "n_events"]


def _run(stream, out, checkpoint):
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return q


def _log(member, ts, key):
    return (dt.datetime.fromisoformat(ts), key, member, "W", "30", "ASIA", None, None, None, None, None, None)


def _feed(spark, path, batches):
    for i, b in enumerate(batches):
        _append_in_order(env.to_binary_record(env.encode_envelope(spark.createDataFrame(b, LOG_SCHEMA))), path, i)


def _got(spark, out):
    rows = spark.read.schema(ms.OUT).parquet(out).collect()
    return sorted((r.member_id, str(r.session_start), str(r.session_end), r.n_events, r.ended_by) for r in rows)


def plain_sessions(events):
    """[(instant, is_logout)] of one member, one by one."""
    out, now = [], None
    for at, logout in sorted(events):
        if now and at > now[1] + GAP:
            out.append((*now, ms.EXPIRY))
            now = None
        now = (now[0] if now else at, at, (now[2] if now else 0) + 1)
        if logout:
            # Events of the same instant behind a logout were sorted before it.
            out.append((*now, ms.LOGOUT))
            now = None
    return out, now


@pytest.mark.parametrize("seed", range(40))
def test_cutting_in_steps_equals_one_by_one(seed):
    rng = random.Random(seed)
    instants = sorted(rng.sample(range(0, 40), rng.randrange(1, 30)))
    events = [(t * 600 * 1_000_000, rng.random() < 0.2) for t in instants]
    done, still, at = [], None, 0
    while at < len(events):
        size = rng.randrange(1, 6)
        part = events[at:at + size]
        at += size
        e = np.array([t for t, _ in part], dtype=np.int64)
        ended, still = ms.ended_sessions(e, np.ones(len(e), dtype=np.int64), np.array([int(x) for _, x in part]), still,
                                         int(e[-1]), GAP)
        done += ended
    assert (done, still) == plain_sessions(events)


def test_logout_ends_a_session(spark, scratch):
    """Login, logout and two events soon after: two sessions, the first at the logout."""
    src, out, check = (os.path.join(scratch, x) for x in ("bus", "out", "check"))
    day = "2024-01-03 "
    _feed(spark, src, [
        [_log("7", day + "12:00:00", "login"), _log("7", day + "12:05:00", "logout"),
         _log("7", day + "12:10:00", "login"), _log("7", day + "12:20:00", "menuclick")],
        [_log("8", day + "15:00:00", "login")]])
    records = jobs.read_bus_stream(spark, TOPICS, path=src, max_files_per_trigger=1)
    _run(jobs.session_stream(records), out, check)
    assert _got(spark, out) == [
        ("7", "2024-01-03 12:00:00", "2024-01-03 12:05:00", 2, "logout"),
        ("7", "2024-01-03 12:10:00", "2024-01-03 12:20:00", 2, "SessionExpired")]


def test_late_and_unordered_rows_and_a_restart(spark, scratch):
    """Rows out of order within the watermark are put in order; later ones are
    dropped; a second run goes on from the state of the first."""
    src, out, check = (os.path.join(scratch, x) for x in ("bus", "out", "check"))
    day = "2024-01-03 "
    _feed(spark, src, [[_log("7", day + "12:08:00", "search"), _log("7", day + "12:00:00", "login")]])
    _run(jobs.session_stream(jobs.read_bus_stream(spark, TOPICS, path=src)), out, check)
    for i, batch in enumerate((
            [_log("7", day + "12:04:00", "logout"), _log("8", day + "12:30:00", "login")],
            [_log("7", day + "12:01:00", "search"), _log("8", day + "12:59:00", "search"), _log("none", day + "12:00:00", "search")],
            [_log("8", day + "14:00:00", "login")])):
        _append_in_order(env.to_binary_record(env.encode_envelope(spark.createDataFrame(batch, LOG_SCHEMA))), src, i + 1)
        q = _run(jobs.session_stream(jobs.read_bus_stream(spark, TOPICS, path=src)), out, check)
    assert jobs.late_rows(q).count() > 0
    assert _got(spark, out) == [
        ("7", "2024-01-03 12:00:00", "2024-01-03 12:04:00", 2, "logout"),
        ("7", "2024-01-03 12:08:00", "2024-01-03 12:08:00", 1, "SessionExpired"),
        ("8", "2024-01-03 12:30:00", "2024-01-03 12:59:00", 2, "SessionExpired")]


def _with_end(spark, logs, src):
    """All logs as bus files, then one far event that lets the watermark pass everything."""
    _bus_files(spark, logs, src)
    far = spark.createDataFrame([_log("far", "2030-01-01 00:00:00", "login")], LOG_SCHEMA)
    _append_in_order(env.to_binary_record(env.encode_envelope(far)), src, 50)


def _millis(logs):
    return logs.withColumn("ts", F.date_trunc("millisecond", "ts"))     # the envelope's precision


def test_stream_equals_batch(spark, scratch):
    logs = fx.logs(spark, SF_SMALL)
    src, out = os.path.join(scratch, "bus"), os.path.join(scratch, "out")
    _with_end(spark, logs, src)
    records = jobs.read_bus_stream(spark, TOPICS, path=src, max_files_per_trigger=1)
    _run(jobs.session_stream(records), out, os.path.join(scratch, "check"))
    got = spark.read.schema(ms.OUT).parquet(out)
    batch = ss.session_windows(_millis(logs), logout_ends=True)
    want = batch.select("member_id", *[F.col(c).cast("timestamp").alias(c) for c in COLUMNS[1:4]], "n_events",
                        F.when(F.col("last_key") == "logout", "logout").otherwise("SessionExpired").alias("ended_by"))
    assert got.count() == want.count() > 100
    assert got.exceptAll(want).count() == 0


def test_expired_stream_equals_batch(spark, scratch):
    logs = fx.logs(spark, SF_SMALL)
    src, out = os.path.join(scratch, "bus"), os.path.join(scratch, "out")
    _with_end(spark, logs, src)
    records = jobs.read_bus_stream(spark, TOPICS, path=src, max_files_per_trigger=1)
    stream = jobs.expired_stream(records)
    _run(stream, out, os.path.join(scratch, "check"))
    got = spark.read.schema(stream.schema).parquet(out)
    want = ss.session_expired(_millis(logs)).drop("observed_at")
    want = want.select(*[F.col(c).cast("timestamp").alias(c) if c in COLUMNS[1:4] else F.col(c) for c in got.columns])
    assert got.count() == want.count() > 50 and got.exceptAll(want).count() == 0
