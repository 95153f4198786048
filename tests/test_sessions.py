"""Sessions and dwell time against a brute-force replay, and the 1800 s edge."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL

from verdant.functions import scalars as S
from verdant.operators import sessions as ss
from verdant.sources import fixtures as fx

GAP = dt.timedelta(seconds=S.SESSION_GAP_SECONDS)


def brute_sessions(rows):
    by = {}
    for r in rows:
        if r.member_id != "none":
            by.setdefault(r.member_id, []).append(r)
    out = set()
    for m, evs in by.items():
        evs.sort(key=lambda r: (r.ts, r.event_id))
        start = last = None
        n = 0
        for r in evs:
            if last is None or r.ts > last.ts + GAP or last.key == "logout":
                if last is not None:
                    out.add((m, start, last.ts, n, last.key))
                start, n = r.ts, 0
            last, n = r, n + 1
        out.add((m, start, last.ts, n, last.key))
    return out


def test_sessions_equal_brute_force(spark):
    logs = fx.logs(spark, SF_SMALL)
    expected = brute_sessions(logs.select("member_id", "ts", "event_id", "key").collect())
    got = {(r.member_id, r.session_start, r.session_end, r.n_events, r.last_key)
           for r in ss.session_windows(logs).collect()}
    assert got == expected


def test_sessions_same_with_day_buckets(spark):
    # The bucket size is a tuning knob only.
    logs = fx.logs(spark, SF_SMALL)
    a = {tuple(r) for r in ss.session_windows(logs, bucket_unit="hour").collect()}
    b = {tuple(r) for r in ss.session_windows(logs, bucket_unit="day").collect()}
    assert a == b


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, m, dt.datetime.fromisoformat(t), k) for i, (m, t, k) in enumerate(rows)],
        "event_id bigint, member_id string, ts timestamp_ntz, key string")


def test_exactly_one_gap_stays_in_session(spark):
    # Exactly 1800 s apart -> same session; one microsecond more -> new.
    ev = _events(spark, [
        ("a", "2024-01-01 10:00:00", "login"),
        ("a", "2024-01-01 10:30:00", "menuclick"),
        ("a", "2024-01-01 11:00:00.000001", "search"),
        ("b", "2024-01-01 10:59:59", "login"),
        ("b", "2024-01-01 11:00:01", "logout"),
    ])
    got = sorted((r.member_id, r.n_events) for r in ss.session_windows(ev).collect())
    assert got == [("a", 1), ("a", 2), ("b", 2)]
    exp = {(r.member_id, r.observed_at) for r in ss.session_expired(ev).collect()}
    assert exp == {("a", dt.datetime(2024, 1, 1, 11, 0, 0, 1)), ("a", None)}


def test_logout_ends_a_session(spark):
    ev = _events(spark, [
        ("a", "2024-01-01 00:00:00", "login"),
        ("a", "2024-01-01 00:05:00", "logout"),
        ("a", "2024-01-01 00:15:00", "login"),
        ("a", "2024-01-01 00:20:00", "search"),
        # all at one instant, and a logout just before a bucket edge
        ("b", "2024-01-01 00:59:59", "login"),
        ("b", "2024-01-01 00:59:59", "logout"),
        ("b", "2024-01-01 00:59:59", "login"),
        ("b", "2024-01-01 00:59:59", "logout"),
        ("b", "2024-01-01 01:00:00", "login"),
    ])
    got = sorted((r.member_id, r.n_events, r.last_key) for r in ss.session_windows(ev).collect())
    assert got == [("a", 2, "logout"), ("a", 2, "search"), ("b", 1, "login"),
                   ("b", 2, "logout"), ("b", 2, "logout")]
    exp = {(r.member_id, r.session_start.minute) for r in ss.session_expired(ev).collect()}
    assert exp == {("a", 15), ("b", 0)}
    whole = ss.session_windows(ev, logout_ends=False).collect()
    assert sorted(r.n_events for r in whole) == [4, 5]


def test_dwell_next_event_must_be_logout(spark):
    ev = _events(spark, [
        ("a", "2024-01-01 10:00:00", "login"),
        ("a", "2024-01-01 10:20:00", "search"),
        ("a", "2024-01-01 10:40:00", "logout"),
        ("a", "2024-01-01 12:00:00", "login"),
        ("a", "2024-01-02 12:00:00", "login"),
    ])
    got = sorted((r.login_ts.hour, r.login_ts.day, r.dwell_seconds) for r in ss.dwell_time(ev).collect())
    assert got == [(10, 1, 2400.0), (12, 1, None), (12, 2, None)]
