"""Queries: sessions, expiry logouts, dwell time, warm tier."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.operators import keyed as kt
from verdant.operators import segments as seg
from verdant.operators import sessions as ss
from verdant.plans.q_segments import COMMON_HOURLY_SQL
from verdant.plans.registry import register
from verdant.plans.sql_views import age_hourly_sql, with_views
from verdant.sources import fixtures as fx

GAP = S.SESSION_GAP_SECONDS
DAY = fx.DASHBOARD_DAY

SESSION_EXTRA = {
    "me": "SELECT member_id, ts, event_id, key FROM logs WHERE member_id <> 'none'",
    "mp": """
  SELECT *, lag(ts) OVER (PARTITION BY member_id ORDER BY ts, event_id) AS prev_ts,
            lag(event_id) OVER (PARTITION BY member_id ORDER BY ts, event_id) AS prev_id,
            lag(key) OVER (PARTITION BY member_id ORDER BY ts, event_id) AS prev_key
  FROM me""",
    "mf": f"""
  SELECT *, CASE WHEN prev_ts IS NULL OR ts > prev_ts + INTERVAL {GAP} SECOND
                 OR prev_key = 'logout' THEN 1 ELSE 0 END AS new FROM mp""",
    "msid": """
  SELECT *, sum(new) OVER (PARTITION BY member_id ORDER BY ts, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM mf""",
    "sess": f"""
  SELECT member_id, sid, min(ts) AS session_start, max(ts) AS session_end,
    max(ts) + INTERVAL {GAP} SECOND AS expires_at, count(*) AS n_events,
    arg_max(key, (ts, event_id)) AS last_key, arg_max(event_id, (ts, event_id)) AS last_event_id
  FROM msid GROUP BY member_id, sid""",
}


@register("session_windows", with_views("""
SELECT member_id, session_start, session_end, expires_at, n_events, last_key, last_event_id
FROM sess""", "logs", extra=SESSION_EXTRA))
def q_session_windows(spark, d):
    return ss.session_windows(fx.logs(spark, d, parts=False))


@register("session_expired", with_views("""
SELECT s.member_id, s.session_start, s.session_end, s.expires_at, n.ts AS observed_at,
  'SessionExpired' AS logout_method
FROM sess s LEFT JOIN (SELECT member_id, prev_id, ts FROM mf WHERE new = 1 AND prev_id IS NOT NULL) n
  ON s.member_id = n.member_id AND s.last_event_id = n.prev_id
WHERE s.last_key <> 'logout'""", "logs", extra=SESSION_EXTRA))
def q_session_expired(spark, d):
    return ss.session_expired(fx.logs(spark, d, parts=False))


# Event types that hold log-ins and log-outs (FIXTURES.md).
INOUT_TYPES = ("signup", "error")

DWELL_BODY = """
SELECT member_id, event_id, login_ts, logout_ts,
  date_diff('microsecond', login_ts, logout_ts) / 1e6 AS dwell_seconds
FROM (SELECT member_id, event_id, ts AS login_ts,
        CASE WHEN next_key = 'logout' THEN next_ts END AS logout_ts, key
      FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(key) OVER w AS next_key
            FROM logs WHERE member_id <> 'none' AND key IN ('login', 'logout')
            WINDOW w AS (PARTITION BY member_id ORDER BY ts, event_id)))
WHERE key = 'login'"""


@register("dwell_time", with_views(DWELL_BODY, "logs"))
def q_dwell_time(spark, d):
    return ss.dwell_time(fx.logs(spark, d, parts=False, types=INOUT_TYPES))


METRICS_SQL = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in seg.METRIC_NAMES)


@register("warm_week", with_views(f"""
SELECT d.*, round(w.avg_dwell_seconds, 3) AS avg_dwell_seconds, w.n_dwell FROM (
  SELECT date, user_age, user_region, user_gender, {METRICS_SQL} FROM hourly
  WHERE date BETWEEN strftime(strptime('{DAY}', '%Y%m%d') - INTERVAL 6 DAY, '%Y%m%d') AND '{DAY}'
  GROUP BY 1, 2, 3, 4) d
LEFT JOIN (
  SELECT strftime(dw.login_ts, '%Y%m%d') AS date, {age_hourly_sql('l.user_age')} AS user_age,
    l.user_region, l.user_gender, avg(dw.dwell_seconds) AS avg_dwell_seconds,
    count(dw.dwell_seconds) AS n_dwell
  FROM dwell dw JOIN logs l ON dw.event_id = l.event_id
  GROUP BY 1, 2, 3, 4) w
ON d.date = w.date AND d.user_age IS NOT DISTINCT FROM w.user_age
  AND d.user_region IS NOT DISTINCT FROM w.user_region AND d.user_gender IS NOT DISTINCT FROM w.user_gender""", "logs", extra={"hourly": COMMON_HOURLY_SQL,
                                                      "dwell": DWELL_BODY}))
def q_warm_week(spark, d):
    # Only later logouts matter to a login, so the lower bound is exact for dwell.
    day_start, day_end = kt.day_range(DAY)
    week_start = day_start - F.make_dt_interval(days=F.lit(6))
    week = fx.logs(spark, d, parts=False).filter((F.col("ts") >= week_start) & (F.col("ts") < day_end))
    inout = fx.logs(spark, d, parts=False, types=INOUT_TYPES).filter(F.col("ts") >= week_start)
    out = ss.warm_week(seg.common_hourly(week), ss.dwell_time(inout, keep=ss.SEGMENT_COLUMNS), DAY)
    return out.withColumn("avg_dwell_seconds", F.round("avg_dwell_seconds", 3))
