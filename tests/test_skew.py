"""Hot keys: one member holds a third of all events. Results must equal a
brute-force replay, and the plans must not window over the member alone."""

from __future__ import annotations

import datetime as dt
import random
import re

from test_sessions import brute_sessions

from verdant.operators import sessions as ss


def _events(spark, n_hot=3000, n_other=6000, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    t = t0
    for i in range(n_hot):
        # bursts within the gap and pauses beyond it, crossing many hours
        t += dt.timedelta(seconds=rnd.choice([5, 60, 600, 1799, 1800, 1801, 4000]))
        rows.append((i, "hot", t, rnd.choice(["login", "search", "logout", "menuclick"])))
    for i in range(n_other):
        m = f"m{rnd.randrange(300)}"
        ts = t0 + dt.timedelta(seconds=rnd.randrange(0, 20 * 86400))
        rows.append((n_hot + i, m, ts, rnd.choice(["login", "search", "logout"])))
    return spark.createDataFrame(rows, "event_id bigint, member_id string, ts timestamp_ntz, key string")


def test_hot_member_sessions_equal_brute_force(spark):
    ev = _events(spark)
    expected = brute_sessions(ev.collect())
    got = {(r.member_id, r.session_start, r.session_end, r.n_events, r.last_key)
           for r in ss.session_windows(ev).collect()}
    assert got == expected
    hot = [s for s in expected if s[0] == "hot"]
    assert len(hot) > 100


def test_hot_member_dwell_equals_brute_force(spark):
    ev = _events(spark)
    io = sorted((r for r in ev.collect() if r.key in ("login", "logout")),
                key=lambda r: (r.member_id, r.ts, r.event_id))
    expected = {}
    for a, b in zip(io, io[1:] + [None]):
        if a.key == "login":
            ok = b is not None and b.member_id == a.member_id and b.key == "logout"
            expected[a.event_id] = (b.ts - a.ts).total_seconds() if ok else None
    got = {r.event_id: r.dwell_seconds for r in ss.dwell_time(ev).collect()}
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert (v is None and got[k] is None) or abs(got[k] - v) < 1e-6


def test_no_window_over_member_alone(spark):
    ev = _events(spark, 100, 100)
    seen = 0
    for df in (ss.session_windows(ev), ss.dwell_time(ev), ss.session_expired(ev)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for spec in re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", plan):
            items = [i.strip() for i in spec.split(",")]
            part = [i.split("#")[0] for i in items if " ASC" not in i and " DESC" not in i]
            order = [i.split("#")[0] for i in items if " ASC" in i or " DESC" in i]
            seen += 1
            if any(o in ("ts", "event_id", "session_start") for o in order):
                # row-level order: only inside (member, bucket) partitions
                assert "_bucket" in part, spec
            else:
                # per-member windows only over the one-row-per-bucket tables
                assert order == ["_bucket"], spec
    assert seen >= 6
