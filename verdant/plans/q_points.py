"""Queries: points rules (R1-R4, A15, A19, A21, J7, F9-F11, P32) and member
answers (P20, P31, A16-A18, A20, J2-J4, F8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.operators import keyed as kt
from verdant.operators import members as mb
from verdant.operators import points as pt
from verdant.operators import segments as seg
from verdant.plans.q_segments import SEARCH_DAILY_SQL
from verdant.plans.registry import register
from verdant.plans.sql_views import with_views
from verdant.sources import fixtures as fx
from verdant.sources.tables import fact_table

KW = fx.RECEIPT_FIXTURE_KEYWORDS
LIMIT = S.UPLOAD_LIMIT_BYTES
CAP1, CAP2 = S.DAILY_CAP[1], S.DAILY_CAP[2]
AS_OF_DAY = fx.LOGS_AS_OF[:10]


def _kw_sql(col: str) -> str:
    t = f"replace({col}, ' ', '')"
    return "(" + " OR ".join(f"contains({t}, '{k}')" for k in KW) + ")"


UPLOAD_CODED = f"""
  SELECT *,
    CASE WHEN size_bytes > {LIMIT} THEN 'ImgOverSize' WHEN pic_time IS NULL THEN 'ImgNoMeta'
         WHEN CAST(pic_time AS DATE) <> day THEN 'ImgNotToday' END AS pre,
    CASE WHEN NOT model_ok THEN 'ModelError' WHEN plastic_n < 1 THEN 'ModelNoPlastic'
         WHEN label_n >= 1 THEN 'ModelYesLabel' END AS post
  FROM uploads"""

UPLOAD_ACC = f"""
  SELECT member_id, day, pic_time AS a_pic, ts AS a_ts, event_id AS a_id, rk FROM (
    SELECT *, row_number() OVER (PARTITION BY member_id, day ORDER BY ts, event_id) AS rk FROM (
      SELECT *, row_number() OVER (PARTITION BY member_id, day, pic_time ORDER BY ts, event_id) AS rp
      FROM coded WHERE pre IS NULL AND post IS NULL) WHERE rp = 1) WHERE rk <= {CAP1}"""

UPLOAD_COUNTED = """
  SELECT c.event_id, count(a.a_id) AS n_before,
         count(CASE WHEN a.a_pic = c.pic_time THEN 1 END) AS same_before
  FROM coded c LEFT JOIN acc a ON a.member_id = c.member_id AND a.day = c.day
    AND (a.a_ts < c.ts OR (a.a_ts = c.ts AND a.a_id < c.event_id))
  GROUP BY c.event_id"""

UPLOAD_VERDICT = f"""
  SELECT c.event_id, c.member_id, c.day, c.service,
    coalesce(c.pre, CASE WHEN n.n_before >= {CAP1} THEN 'OverCount'
                         WHEN n.n_before = 1 AND n.same_before >= 1 THEN 'ImgDuplicated' END,
             c.post, '') AS verdict,
    c.plastic_n
  FROM coded c JOIN counted n ON c.event_id = n.event_id"""

UPLOAD_EXTRA = {"coded": UPLOAD_CODED, "acc": UPLOAD_ACC, "counted": UPLOAD_COUNTED,
                "verdicts": UPLOAD_VERDICT}
UPLOAD_OUT = """SELECT event_id, member_id, day, service, verdict,
  CAST(CASE WHEN verdict = '' THEN plastic_n * 10 ELSE 0 END AS INTEGER) AS points FROM verdicts"""


@register("upload_verdict", with_views(UPLOAD_OUT, "uploads", extra=UPLOAD_EXTRA))
def q_upload_verdict(spark, d):
    return pt.upload_verdict(fx.uploads(spark, d))


RECEIPT_EXTRA = {
    "rcoded": f"""
  SELECT *, CASE WHEN NOT model_ok THEN 'ModelError'
                 WHEN NOT coalesce({_kw_sql('ocr_text')}, false) THEN 'OcrNoDetect' END AS post
  FROM receipts""",
    "racc": f"""
  SELECT member_id, day, ts AS a_ts, event_id AS a_id FROM (
    SELECT *, row_number() OVER (PARTITION BY member_id, day ORDER BY ts, event_id) AS rk
    FROM rcoded WHERE post IS NULL) WHERE rk <= {CAP2}""",
    "rcounted": """
  SELECT c.event_id, count(a.a_id) AS n_before
  FROM rcoded c LEFT JOIN racc a ON a.member_id = c.member_id AND a.day = c.day
    AND (a.a_ts < c.ts OR (a.a_ts = c.ts AND a.a_id < c.event_id))
  GROUP BY c.event_id""",
    "rverdicts": f"""
  SELECT c.event_id, c.member_id, c.day, c.service,
    coalesce(CASE WHEN n.n_before >= {CAP2} THEN 'OverCount' END, c.post, '') AS verdict
  FROM rcoded c JOIN rcounted n ON c.event_id = n.event_id""",
}
RECEIPT_OUT = """SELECT event_id, member_id, day, service, verdict,
  CAST(CASE WHEN verdict = '' THEN 10 * (1 + event_id % 5) ELSE 0 END AS INTEGER) AS points
  FROM rverdicts"""


@register("receipt_verdict", with_views(RECEIPT_OUT, "receipts", extra=RECEIPT_EXTRA))
def q_receipt_verdict(spark, d):
    return pt.receipt_verdict(fx.receipts(spark, d, keywords=KW), KW)


@register("fail_codes", with_views("""
SELECT service, verdict, count(*) AS n FROM (
  SELECT service, verdict FROM verdicts UNION ALL SELECT service, verdict FROM rverdicts)
GROUP BY 1, 2""", "uploads", "receipts", extra={**UPLOAD_EXTRA, **RECEIPT_EXTRA}))
def q_fail_codes(spark, d):
    return pt.fail_codes(fx.uploads(spark, d), fx.receipts(spark, d, keywords=KW), KW)


@register("dup_upload", with_views("""
SELECT event_id, member_id, day, pic_time,
  row_number() OVER (PARTITION BY member_id, day, pic_time ORDER BY ts, event_id) > 1 AS repeat
FROM coded WHERE pre IS NULL AND post IS NULL""", "uploads", extra={"coded": UPLOAD_CODED}))
def q_dup_upload(spark, d):
    return pt.repeat_uploads(fx.uploads(spark, d))


@register("daily_cap", with_views("""
SELECT member_id, day, a_ts AS ts, a_id AS event_id, a_pic AS pic_time, CAST(rk AS INTEGER) AS rank
FROM acc""", "uploads", extra={"coded": UPLOAD_CODED, "acc": UPLOAD_ACC}))
def q_daily_cap(spark, d):
    return pt.daily_cap(fx.uploads(spark, d))


@register("receipt_keyword", with_views(f"""
SELECT event_id, {_kw_sql('ocr_text')} AS matched FROM receipts""", "receipts"))
def q_receipt_keyword(spark, d):
    return fx.receipts(spark, d, keywords=KW).select("event_id", "matched")


@register("receipt_points", with_views("""
SELECT event_id, CAST(10 * (1 + event_id % 5) AS INTEGER) AS points FROM receipts""",
                                       "receipts"))
def q_receipt_points(spark, d):
    return fx.receipts(spark, d, documents=False).select("event_id", S.receipt_points("event_id").alias("points"))


@register("photo_points", with_views("""
SELECT photo_id, plastic, label,
  CASE WHEN plastic < 1 THEN 'ModelNoPlastic' WHEN label >= 1 THEN 'ModelYesLabel' ELSE '' END
    AS verdict,
  CAST(CASE WHEN plastic >= 1 AND label < 1 THEN plastic * 10 ELSE 0 END AS INTEGER) AS points
FROM (SELECT photo_id,
  CAST(sum(CASE WHEN name = 'plastic' AND confidence >= 0.5 THEN 1 ELSE 0 END) AS INTEGER) AS plastic,
  CAST(sum(CASE WHEN name = 'label' AND confidence >= 0.5 THEN 1 ELSE 0 END) AS INTEGER) AS label
  FROM photos GROUP BY photo_id)""", "photos"))
def q_photo_points(spark, d):
    return pt.photo_points(fx.photos(spark, d))


@register("points_ledger", with_views("""
SELECT member_id, strftime(ts, '%Y-%m') AS month_kb, CAST(sum(save_point) AS BIGINT) AS point_amt
FROM logs WHERE key IN ('1', '2') AND member_id <> 'none' GROUP BY 1, 2""", "logs"))
def q_points_ledger(spark, d):
    return pt.points_ledger(fx.logs(spark, d, parts=False, types=("purchase",)))


@register("training_manifest", with_views("""
SELECT u.event_id, u.member_id, u.pic_time, r.result_id, r.result_id IS NOT NULL AS has_result
FROM uploads u LEFT JOIN results r ON u.member_id = r.member_id AND u.pic_time = r.pic_time
WHERE u.pic_time IS NOT NULL""", "uploads", "results"))
def q_training_manifest(spark, d):
    return pt.training_manifest(fx.uploads(spark, d), fx.results(spark, d))


# ---------------------------------------------------------------------------
# Members
# ---------------------------------------------------------------------------
@register("member_age", with_views(f"""
SELECT member_id, birth_dt,
  CAST(year(DATE '{AS_OF_DAY}') - TRY_CAST(substr(birth_dt, 1, 4) AS INTEGER) + 1 AS INTEGER)
    AS user_age
FROM members""", "members"))
def q_member_age(spark, d):
    return mb.member_age(fx.members(spark, d), AS_OF_DAY)


@register("enrich_events", with_views(f"""
SELECT e.event_id, e.user_id,
  CASE WHEN e.user_id % 10 = 0 OR m.user_id IS NULL THEN 'none' ELSE m.member_id END AS member_id,
  CASE WHEN e.user_id % 10 = 0 OR m.user_id IS NULL THEN 'none' ELSE m.gender_kb END AS user_gender,
  CASE WHEN e.user_id % 10 = 0 OR m.user_id IS NULL THEN 'none'
       ELSE CAST(CAST(year(DATE '{AS_OF_DAY}') - TRY_CAST(substr(m.birth_dt, 1, 4) AS INTEGER) + 1
                      AS INTEGER) AS VARCHAR) END AS user_age,
  CASE WHEN e.user_id % 10 = 0 OR m.user_id IS NULL THEN 'none' ELSE m.region_kb END AS user_region
FROM events e LEFT JOIN members m ON e.user_id = m.user_id""", "members"))
def q_enrich_events(spark, d):
    events = fact_table(spark, d, "events", "event_id", "user_id")
    return mb.enrich_events(events, fx.members(spark, d), AS_OF_DAY,
                            visitor=F.col("user_id") % 10 == 0)


@register("member_total", with_views("""
SELECT member_id, CAST(sum(point_amt) AS BIGINT) AS total FROM ledger GROUP BY 1""", "ledger"))
def q_member_total(spark, d):
    return mb.member_total(fx.ledger(spark, d))


GRADE_SQL = "CASE " + " ".join(f"WHEN t <= {b} THEN {g}" for b, g, _ in S.GRADE_BANDS) + \
    f" ELSE {S.TOP_GRADE[0]} END"
TEMP_SQL = "CASE " + " ".join(f"WHEN t <= {b} THEN '{tp}'" for b, _, tp in S.GRADE_BANDS) + \
    f" ELSE '{S.TOP_GRADE[1]}' END"


@register("member_grade", with_views(f"""
SELECT member_id, t AS total, CAST({GRADE_SQL} AS INTEGER) AS grade, {TEMP_SQL} AS temp
FROM (SELECT c.c_custkey AS member_id, CAST(coalesce(s.total, 0) AS BIGINT) AS t
      FROM customer c LEFT JOIN (SELECT member_id, sum(point_amt) AS total FROM ledger GROUP BY 1) s
      ON c.c_custkey = s.member_id)""", "ledger"))
def q_member_grade(spark, d):
    members = fx.members(spark, d).select(F.col("user_id").alias("member_id"))
    return mb.member_grade(members, fx.ledger(spark, d))


LEDGER_AS_OF = fx.LEDGER_AS_OF


@register("member_vs_all", with_views(f"""
SELECT o.month_kb, o.member_id, o.point_amt, a.avg_point_amt FROM (
  SELECT member_id, month_kb, point_amt FROM recent
  UNION ALL
  SELECT c.c_custkey, strftime(DATE '{LEDGER_AS_OF}', '%Y-%m'), CAST(0 AS BIGINT) FROM customer c
  WHERE c.c_custkey NOT IN (SELECT member_id FROM recent)) o
LEFT JOIN (SELECT month_kb, avg(point_amt) AS avg_point_amt FROM recent GROUP BY 1) a
  ON o.month_kb = a.month_kb""", "ledger", extra={"recent": f"""
  SELECT * FROM ledger WHERE month_kb BETWEEN strftime(DATE '{LEDGER_AS_OF}' - INTERVAL 3 MONTH, '%Y-%m')
    AND strftime(DATE '{LEDGER_AS_OF}', '%Y-%m')"""}))
def q_member_vs_all(spark, d):
    members = fx.members(spark, d).select(F.col("user_id").alias("member_id"))
    return mb.member_vs_all(fx.ledger(spark, d), members, LEDGER_AS_OF)


def _top_body(by: str) -> str:
    return f"""
SELECT date, {by}, word, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY date, {by} ORDER BY count DESC, word ASC) AS rank
  FROM (SELECT date, {by}, word, CAST(sum(count) AS BIGINT) AS count FROM search GROUP BY 1, 2, 3))
WHERE rank <= 5"""


def _top_sql(by: str) -> str:
    return with_views(_top_body(by), "logs", extra={"search": SEARCH_DAILY_SQL})


@register("top5_by_age", _top_sql("age"))
def q_top5_by_age(spark, d):
    return mb.top_words(seg.search_daily(fx.logs(spark, d, types=("view",))), "age")


@register("top5_by_gender", _top_sql("gender"))
def q_top5_by_gender(spark, d):
    return mb.top_words(seg.search_daily(fx.logs(spark, d, types=("view",))), "gender")


def _member_top_sql(by: str) -> str:
    member_key = (f"CAST(CASE WHEN a >= 60 THEN 60 ELSE 10 * floor(a / 10) END AS BIGINT)"
                  if by == "age" else "gender_kb")
    return with_views(f"""
SELECT m.member_id, t.{by}, t.word, t.count, t.rank FROM (
  SELECT member_id, {member_key} AS {by} FROM (
    SELECT member_id, gender_kb,
      year(DATE '{AS_OF_DAY}') - TRY_CAST(substr(birth_dt, 1, 4) AS INTEGER) + 1 AS a
    FROM members)) m
JOIN (SELECT * FROM top WHERE date = '{fx.DASHBOARD_DAY}') t ON m.{by} = t.{by}""",
                      "logs", "members", extra={"search": SEARCH_DAILY_SQL,
                                                "top": _top_body(by)})


def _day_searches(spark, d):
    """The search counts of one day; its time range reaches the scan."""
    start, end = kt.day_range(fx.DASHBOARD_DAY)
    return seg.search_daily(fx.logs(spark, d, types=("view",)).filter((F.col("ts") >= start) & (F.col("ts") < end)))


@register("member_top5_age", _member_top_sql("age"))
def q_member_top5_age(spark, d):
    top = mb.top_words(_day_searches(spark, d), "age")
    return mb.member_top_words(fx.members(spark, d), top, fx.DASHBOARD_DAY, "age", AS_OF_DAY)


@register("member_top5_gender", _member_top_sql("gender"))
def q_member_top5_gender(spark, d):
    top = mb.top_words(_day_searches(spark, d), "gender")
    return mb.member_top_words(fx.members(spark, d), top, fx.DASHBOARD_DAY, "gender", AS_OF_DAY)


@register("dup_signup", with_views("""
SELECT event_id, user_id,
  CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END
    AS id_check
FROM events WHERE event_type = 'signup'"""))
def q_dup_signup(spark, d):
    signups = fact_table(spark, d, "events", "event_id", "ts", "user_id", "event_type") \
        .filter(F.col("event_type") == "signup").select("event_id", "ts", "user_id")
    return mb.signup_check(signups)
