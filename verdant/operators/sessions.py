"""Inactivity sessions, synthetic expiry logouts, login-to-logout dwell time.

A plain ``Window.partitionBy(member).orderBy(ts)`` sends all events of a
member to one task; one busy member could hold a third of all rows. These
operators instead order events inside (member, time bucket) windows, and
carry what crosses a bucket edge (the previous or next row, the last
session start) through a per-(member, bucket) table that has one row per
active bucket. That table is joined back on (member, bucket), one row per
key, so AQE can split a skewed side or broadcast the small one.

Sessions exclude visitors: ``none`` is not an identity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions import scalars as S


def gap() -> Column:
    return F.make_dt_interval(secs=F.lit(S.SESSION_GAP_SECONDS))


def _bucket(ts: str, unit: str) -> Column:
    return F.date_trunc(unit, F.col(ts))


def adjacent(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             payload: Sequence[str], name: str, direction: str = "prev",
             ts: str = "ts", bucket_unit: str = "hour") -> DataFrame:
    """Add ``name`` = struct(order..., payload...) of the previous (``prev``)
    or next (``next``) row per ``keys`` in ``order``, or null at the edge."""
    keys, prev = list(keys), direction == "prev"
    rec = F.struct(*[F.col(c) for c in list(order) + list(payload)])
    b = "_bucket"
    d = df.withColumn(b, _bucket(ts, bucket_unit))
    w = Window.partitionBy(*keys, b).orderBy(*order)
    local = (F.lag if prev else F.lead)(rec).over(w)
    edge = d.groupBy(*keys, b).agg((F.max if prev else F.min)(rec).alias("_edge"))
    bw = Window.partitionBy(*keys).orderBy(b)
    carried = edge.select(*keys, b, (F.lag if prev else F.lead)("_edge").over(bw).alias("_carried"))
    out = d.withColumn("_local", local).join(carried, keys + [b], "left")
    return out.withColumn(name, F.coalesce("_local", "_carried")).drop("_local", "_carried")


def member_events(logs: DataFrame, time_col: str = "ts", keep: Sequence[str] = ()) -> DataFrame:
    """Member events (visitors excluded). ``keep``: columns carried along."""
    return logs.filter(F.col("member_id") != S.VISITOR).select(
        "member_id", F.col(time_col).alias("ts"), "event_id", "key", *keep)


BUCKET_SECONDS = {"hour": 3600, "day": 86400}


def sessionize(events: DataFrame, bucket_unit: str = "hour",
               logout_ends: bool = True) -> DataFrame:
    """Each event with ``session_start`` and ``first_event_id`` of its session.
    A new session begins when more than the gap passed since the member's
    previous event (exactly the gap stays) and, with ``logout_ends``, after
    every logout; the logout itself closes the session it lies in.

    Only a previous event within the gap matters, and with buckets at least
    the gap long it lies in the same bucket or in the last ``gap`` of the
    previous one. Those events are copied into the next bucket as context
    rows, so one (member, bucket) window finds every session start. The
    running start then crosses bucket edges through the per-bucket table. A
    start is (ts, event_id), since two sessions can begin at one instant.
    """
    if BUCKET_SECONDS.get(bucket_unit, 0) < S.SESSION_GAP_SECONDS:
        raise ValueError("bucket must be at least as long as the session gap")
    step = F.make_dt_interval(secs=F.lit(BUCKET_SECONDS[bucket_unit]))
    own = _bucket("ts", bucket_unit)
    # One pass: an event in the last ``gap`` of its bucket is emitted twice,
    # the second time as a context row of the next bucket.
    buckets = F.when(F.col("ts") >= own + step - gap(), F.array(own, own + step)) \
               .otherwise(F.array(own))
    rows = events.select("*", F.explode(buckets).alias("_bucket")) \
                 .withColumn("_ctx", F.col("_bucket") != own)
    w = Window.partitionBy("member_id", "_bucket").orderBy("ts", "event_id")
    prev = F.lag(F.struct("ts", "key")).over(w)
    new = prev.isNull() | (F.col("ts") > prev["ts"] + gap())
    if logout_ends:
        new = new | F.coalesce(prev["key"] == "logout", F.lit(False))
    rows = rows.withColumn("_new", new).filter(~F.col("_ctx"))
    start_if_new = F.when(F.col("_new"), F.struct("ts", "event_id"))
    local = F.max(start_if_new).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_local", local)
    last_start = rows.groupBy("member_id", "_bucket").agg(F.max(start_if_new).alias("_ls"))
    bw = Window.partitionBy("member_id").orderBy("_bucket") \
               .rowsBetween(Window.unboundedPreceding, -1)
    carried = last_start.select("member_id", "_bucket", F.max("_ls").over(bw).alias("_carried"))
    out = rows.join(carried, ["member_id", "_bucket"], "left")
    start = F.coalesce("_local", "_carried")
    return out.withColumn("session_start", start["ts"]) \
              .withColumn("first_event_id", start["event_id"]) \
              .drop("_local", "_carried", "_bucket", "_ctx", "_new")


def _sessions(logs: DataFrame, time_col: str, bucket_unit: str, logout_ends: bool) -> DataFrame:
    e = sessionize(member_events(logs, time_col), bucket_unit, logout_ends)
    last = F.max(F.struct("ts", "event_id", "key"))
    s = e.groupBy("member_id", "session_start", "first_event_id").agg(
        last.alias("_last"), F.count(F.lit(1)).alias("n_events"))
    return s.select("member_id", "session_start", "first_event_id",
                    F.col("_last.ts").alias("session_end"),
                    (F.col("_last.ts") + gap()).alias("expires_at"),
                    "n_events",
                    F.col("_last.key").alias("last_key"),
                    F.col("_last.event_id").alias("last_event_id"))


def session_windows(logs: DataFrame, time_col: str = "ts", bucket_unit: str = "hour",
                    logout_ends: bool = True) -> DataFrame:
    """One row per session: start, last activity, expiry, events, last key."""
    return _sessions(logs, time_col, bucket_unit, logout_ends).drop("first_event_id")


def session_expired(logs: DataFrame, time_col: str = "ts", bucket_unit: str = "hour") -> DataFrame:
    """Sessions not closed by a logout get a synthetic ``SessionExpired``
    logout. ``observed_at`` is when the expiry would be noticed: the start of
    the member's next session (null when none follows), found on the sessions
    table with the bucketed neighbour search."""
    s = _sessions(logs, time_col, bucket_unit, logout_ends=True)
    s = adjacent(s, ["member_id"], ["session_start", "first_event_id"], [], "next", "next",
                 ts="session_start", bucket_unit=bucket_unit)
    return s.filter(F.col("last_key") != "logout").select(
        "member_id", "session_start", "session_end", "expires_at",
        F.col("next.session_start").alias("observed_at"),
        F.lit("SessionExpired").alias("logout_method"))


def seconds_between(start, end) -> Column:
    micros = F.expr(f"timestampdiff(MICROSECOND, {start}, {end})")
    return micros / F.lit(1e6)


def dwell_time(logs: DataFrame, time_col: str = "ts", bucket_unit: str = "hour",
               keep: Sequence[str] = ()) -> DataFrame:
    """Each member login with the logout that follows it, if the member's
    next log-in/out event is a logout, and the seconds in between. ``keep``:
    columns of the login row carried to the output."""
    io = member_events(logs.filter(F.col("key").isin("login", "logout")), time_col, keep)
    e = adjacent(io, ["member_id"], ["ts", "event_id"], ["key"], "next", "next",
                 bucket_unit=bucket_unit)
    logins = e.filter(F.col("key") == "login")
    out_ts = F.when(F.col("next.key") == "logout", F.col("next.ts"))
    return logins.select("member_id", "event_id", F.col("ts").alias("login_ts"),
                         out_ts.alias("logout_ts"), *keep) \
                 .withColumn("dwell_seconds", seconds_between("login_ts", "logout_ts"))


SEGMENT_COLUMNS = ("user_age", "user_region", "user_gender")


def warm_week(hourly: DataFrame, dwell: DataFrame, day: str, days: int = 7) -> DataFrame:
    """The last ``days`` days up to ``day`` of the segment table, summed
    per day and segment, with the average dwell time of that segment's logins
    (``dwell`` from ``dwell_time(..., keep=SEGMENT_COLUMNS)``)."""
    end = F.to_date(F.lit(day), "yyyyMMdd")
    lo = F.date_format(F.date_sub(end, days - 1), "yyyyMMdd")
    week = hourly.filter(F.col("date").between(lo, F.lit(day)))
    metrics = [c for c in hourly.columns if c not in ("date", "hour", "user_age",
                                                     "user_region", "user_gender")]
    daily = week.groupBy("date", "user_age", "user_region", "user_gender").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in metrics])
    d = dwell.select(S.day_text("login_ts").alias("date"),
                     S.age_band_hourly("user_age").alias("user_age"),
                     "user_region", "user_gender", "dwell_seconds") \
             .filter(F.col("date").between(lo, F.lit(day)))
    dwell_seg = d.groupBy("date", "user_age", "user_region", "user_gender").agg(
        F.avg("dwell_seconds").alias("avg_dwell_seconds"),
        F.count("dwell_seconds").alias("n_dwell"))
    keys = ["date", "user_age", "user_region", "user_gender"]
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return daily.alias("d").join(dwell_seg.alias("s"), same, "left").select(
        "d.*", "s.avg_dwell_seconds", "s.n_dwell")
