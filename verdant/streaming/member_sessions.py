"""W9 and W10 as a stream: sessions that end at a logout or run out.

One small state per member: events the watermark hasn't passed yet (summed
up per instant) and the session that is open. What the watermark has passed
is in its final order, so it is cut into sessions exactly as the batch form
does: a new session begins after a logout, or more than the gap after the
member's previous event. An event-time timer wakes the member up when its
next event becomes final or its open session runs out; a session that ran
out is emitted then, without waiting for a next event of the member.

Late rows (at or before the watermark) are dropped by Spark before they get
here. Needs the RocksDB state store (``session.DEFAULT_CONF``); the state
lies in the checkpoint, so a lost executor or a restart goes on from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from verdant.functions import scalars as S

#: Instants of pending events in microseconds, how many events and logouts
#: each holds, the open session (null: none), and the timer that is set.
STATE = ("at array<bigint>, events array<bigint>, logouts array<bigint>, "
         "open_start bigint, open_last bigint, open_events bigint, timer bigint")
OUT = ("member_id string, session_start timestamp, session_end timestamp, expires_at timestamp, "
       "n_events bigint, ended_by string")
LOGOUT, EXPIRY = "logout", "SessionExpired"


def ended_sessions(at: np.ndarray, events: np.ndarray, logouts: np.ndarray, open_session: tuple | None,
                   passed: int, gap: int) -> tuple[list[tuple], tuple | None]:
    """Cut final events (ascending instants) behind an open session into sessions.

    Returns (start, last, events, ended_by) of those that ended by ``passed``,
    and the one still open. A logout ends its session; logouts come last among
    the events of one instant."""
    start = at
    if open_session:
        first, last, n = open_session
        at, start = np.r_[last, at], np.r_[first, start]
        events, logouts = np.r_[n, events], np.r_[0, logouts]
    if not len(at):
        return [], None
    opens = np.r_[True, (np.diff(at) > gap) | (logouts[:-1] > 0)]
    first = np.flatnonzero(opens)
    last = np.r_[first[1:] - 1, len(at) - 1]
    total = np.add.reduceat(events, first)
    found = [(int(start[f]), int(at[z]), int(n), LOGOUT if logouts[z] else EXPIRY)
             for f, z, n in zip(first, last, total, strict=True)]
    if found[-1][3] == EXPIRY and found[-1][1] + gap > passed:
        return found[:-1], found[-1][:3]
    return found, None


class MemberSessions(StatefulProcessor):
    """State and timers of one member (see the module's text)."""

    def __init__(self, gap_seconds: int = S.SESSION_GAP_SECONDS):
        self.gap = gap_seconds * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [f.groupby("at", sort=False)[["events", "logouts"]].sum() for f in rows]
        new = pd.concat(frames).groupby(level=0).sum() if len(frames) > 1 else frames[0]
        return self._go_on(key, timerValues, new.index.to_numpy(), new["events"].to_numpy(), new["logouts"].to_numpy())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, dtype=np.int64)
        return self._go_on(key, timerValues, none, none, none)

    def close(self) -> None:
        pass

    def _go_on(self, key, timer_values, *new: np.ndarray) -> Iterator[pd.DataFrame]:
        passed = timer_values.getCurrentWatermarkInMs() * 1000
        old = self.state.get() if self.state.exists() else ((), (), (), None, None, None, None)
        at, events, logouts = (np.r_[np.array(a or (), dtype=np.int64), b] for a, b in zip(old[:3], new, strict=True))
        where, place = np.unique(at, return_inverse=True)
        events = np.bincount(place, weights=events, minlength=len(where)).astype(np.int64)
        logouts = np.bincount(place, weights=logouts, minlength=len(where)).astype(np.int64)
        final = int(np.searchsorted(where, passed, side="right"))
        ended, still = ended_sessions(where[:final], events[:final], logouts[:final],
                                      None if old[3] is None else tuple(old[3:6]), passed, self.gap)
        wake = [int(where[final])] if final < len(where) else []
        if still:
            wake.append(still[1] + self.gap)
        timer = max(-(-min(wake) // 1000), passed // 1000 + 1) if wake else None
        if old[6] is not None and old[6] != timer:
            self.handle.deleteTimer(old[6])
        if timer is None:
            self.state.clear()
        else:
            if old[6] != timer or timer <= passed // 1000 + 1:
                self.handle.registerTimer(timer)
            self.state.update(([int(x) for x in where[final:]], [int(x) for x in events[final:]],
                               [int(x) for x in logouts[final:]], *(still or (None, None, None)), timer))
        if ended:
            first, last, n, by = zip(*ended, strict=True)
            yield pd.DataFrame({
                "member_id": key[0], "session_start": pd.to_datetime(first, unit="us"),
                "session_end": pd.to_datetime(last, unit="us"),
                "expires_at": pd.to_datetime([x + self.gap for x in last], unit="us"), "n_events": n, "ended_by": by})


def session_stream(logs: DataFrame, watermark: str = "10 minutes", gap_seconds: int = S.SESSION_GAP_SECONDS) -> DataFrame:
    """Sessions of a stream of flat log rows (``member_id``, ``ts`` timestamp,
    ``key``), each once it has ended: member_id, session_start, session_end,
    expires_at, n_events, ended_by (``logout`` or ``SessionExpired``). Visitors
    and rows without a member or a time have no session; ``ts`` counts in
    microseconds; among events of one instant the logout comes last."""
    rows = logs.filter((F.col("member_id") != S.VISITOR) & F.col("ts").isNotNull()).withWatermark("ts", watermark)
    rows = rows.select("member_id", "ts", F.unix_micros("ts").alias("at"), F.lit(1).cast("bigint").alias("events"),
                       F.coalesce(F.col("key") == "logout", F.lit(False)).cast("bigint").alias("logouts"))
    return rows.groupBy("member_id").transformWithStateInPandas(
        MemberSessions(gap_seconds), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def expired_stream(logs: DataFrame, watermark: str = "10 minutes", gap_seconds: int = S.SESSION_GAP_SECONDS) -> DataFrame:
    """The synthetic logout of every session that ran out, when it does."""
    sessions = session_stream(logs, watermark, gap_seconds).filter(F.col("ended_by") == EXPIRY)
    return sessions.select("member_id", "session_start", "session_end", "expires_at", F.col("ended_by").alias("logout_method"))
