"""Points rules: upload and receipt verdicts, daily caps, duplicates, ledger.

The reference decides each upload inside a web request against a per-member
cache. Set-wise, the only history that matters per (member, day) is the
first ``cap`` accepted uploads, so the jobs compute exactly those and join
them back:

1. ``pre`` = stateless image code, ``post`` = stateless model code;
2. *candidates* have neither;
3. first candidate per (member, day, pic_time) by a partial aggregate, then
   the first ``cap`` of those per (member, day) via ``row_number() <= cap``
   (Spark pre-limits each map partition before the shuffle, so a hot member
   never reaches one task with all its rows);
4. the accepted rows, at most ``cap`` per key, are packed into a small array
   and joined back to every upload;
5. verdict = ``coalesce(pre, quota/duplicate, post, '')``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.session import materialize

ACCEPTED = ""
KEYS = ["member_id", "day"]


def _order() -> Column:
    return F.struct(F.col("ts"), F.col("event_id"))


def upload_pre(limit: int = S.UPLOAD_LIMIT_BYTES) -> Column:
    return (F.when(F.col("size_bytes") > limit, "ImgOverSize")
            .when(F.col("pic_time").isNull(), "ImgNoMeta")
            .when(F.to_date("pic_time") != F.col("day"), "ImgNotToday"))


def upload_post() -> Column:
    return (F.when(~F.col("model_ok"), "ModelError")
            .when(F.col("plastic_n") < 1, "ModelNoPlastic")
            .when(F.col("label_n") >= 1, "ModelYesLabel"))


def receipt_post(matched: Column) -> Column:
    return (F.when(~F.col("model_ok"), "ModelError")
            .when(~F.coalesce(matched, F.lit(False)), "OcrNoDetect"))


def first_per_photo(cands: DataFrame, dedupe: str | None) -> DataFrame:
    """R2: the first candidate per (member, day[, dedupe]) as ``o`` = (ts, event_id)."""
    cols = KEYS + ([dedupe] if dedupe else [])
    if dedupe is None:
        return cands.select(*cols, _order().alias("o"))
    return cands.groupBy(*cols).agg(F.min(_order()).alias("o"))


def accepted_rows(cands: DataFrame, cap: int, dedupe: str | None) -> DataFrame:
    """The first ``cap`` accepted rows per (member, day) with their rank."""
    firsts = first_per_photo(cands, dedupe)
    w = Window.partitionBy(*KEYS).orderBy("o")
    ranked = firsts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= cap)
    return ranked.select(*KEYS, F.col("o.ts").alias("ts"), F.col("o.event_id").alias("event_id"),
                         *([F.col(dedupe)] if dedupe else []), "rank")


def apply_quota(rows: DataFrame, pre: Column | None, post: Column, cap: int,
                dedupe: str | None) -> DataFrame:
    """Verdict per row; adds ``verdict``."""
    coded = rows.withColumn("_pre", pre if pre is not None else F.lit(None).cast("string")) \
                .withColumn("_post", post)
    cands = coded.filter(F.col("_pre").isNull() & F.col("_post").isNull())
    acc = accepted_rows(cands, cap, dedupe)
    fields = [F.col("ts"), F.col("event_id")] + ([F.col(dedupe).alias("d")] if dedupe else [])
    packed = acc.groupBy(*KEYS).agg(F.collect_list(F.struct(*fields)).alias("_acc"))
    j = coded.join(packed, KEYS, "left")
    me = _order()
    before = F.filter(F.coalesce(F.col("_acc"), F.array()),
                      lambda a: F.struct(a["ts"], a["event_id"]) < me)
    n_before = F.size(before)
    quota = F.when(n_before >= cap, "OverCount")
    if dedupe:
        same = F.exists(before, lambda a: a["d"] == F.col(dedupe))
        quota = quota.when((n_before == 1) & same, "ImgDuplicated")
    verdict = F.coalesce(F.col("_pre"), quota, F.col("_post"), F.lit(ACCEPTED))
    return j.withColumn("verdict", verdict).drop("_pre", "_post", "_acc")


def upload_verdict(uploads: DataFrame, cap: int = S.DAILY_CAP[1],
                   limit: int = S.UPLOAD_LIMIT_BYTES) -> DataFrame:
    """Verdict and points for each photo upload of service 1."""
    v = apply_quota(uploads, upload_pre(limit), upload_post(), cap, "pic_time")
    points = F.when(F.col("verdict") == ACCEPTED, F.col("plastic_n") * 10).otherwise(0)
    return v.select("event_id", "member_id", "day", "service", "verdict",
                    points.cast("int").alias("points"))


def receipt_verdict(receipts: DataFrame, keywords=S.RECEIPT_KEYWORDS,
                    cap: int = S.DAILY_CAP[2], points_method: str = "mod") -> DataFrame:
    """OverCount, ModelError, OcrNoDetect, else accepted with P32 points.
    Receipts carry ``ocr_text``, or ``matched`` when their texts are tested already."""
    matched = F.col("matched") if "matched" in receipts.columns \
        else S.contains_any("ocr_text", keywords)
    v = apply_quota(receipts, None, receipt_post(matched), cap, None)
    points = F.when(F.col("verdict") == ACCEPTED,
                    S.receipt_points("event_id", points_method)).otherwise(0)
    return v.select("event_id", "member_id", "day", "service", "verdict",
                    points.cast("int").alias("points"))


def upload_candidates(uploads: DataFrame, limit: int = S.UPLOAD_LIMIT_BYTES) -> DataFrame:
    return uploads.filter(upload_pre(limit).isNull() & upload_post().isNull())


def repeat_uploads(uploads: DataFrame) -> DataFrame:
    """R2: candidates flagged when an earlier candidate has the same member,
    day and capture time. The first per photo comes from a partial aggregate
    joined back (one row per key), not from a window over a possibly hot key."""
    cands = upload_candidates(uploads)
    firsts = first_per_photo(cands, "pic_time")
    j = cands.join(firsts, KEYS + ["pic_time"], "left")
    return j.select("event_id", "member_id", "day", "pic_time",
                    (_order() > F.col("o")).alias("repeat"))


def daily_cap(uploads: DataFrame, cap: int = S.DAILY_CAP[1]) -> DataFrame:
    """The accepted uploads per member and day, ranked, at most ``cap``."""
    return accepted_rows(upload_candidates(uploads), cap, "pic_time")


def fail_codes(uploads: DataFrame, receipts: DataFrame, keywords=S.RECEIPT_KEYWORDS) -> DataFrame:
    """Outcome counts per service. Both services' requests are coded once,
    into one narrow table; the quotas' two readers, the accepted rows and the
    requests they are joined to, start from that table."""
    narrow = ["event_id", "member_id", "day", "service", "ts"]
    matched = F.col("matched") if "matched" in receipts.columns else S.contains_any("ocr_text", keywords)
    coded = materialize(
        uploads.select(*narrow, "pic_time", upload_pre().alias("pre"), upload_post().alias("post")).unionByName(
            receipts.select(*narrow, F.lit(None).cast("timestamp_ntz").alias("pic_time"),
                            F.lit(None).cast("string").alias("pre"), receipt_post(matched).alias("post"))))
    verdicts = [apply_quota(coded.filter(F.col("service") == service), F.col("pre"), F.col("post"), S.DAILY_CAP[service], dedupe)
                for service, dedupe in ((1, "pic_time"), (2, None))]
    return verdicts[0].unionByName(verdicts[1]).groupBy("service", "verdict").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Detections
# ---------------------------------------------------------------------------
def photo_points(detections: DataFrame, threshold: float = S.DETECTION_THRESHOLD) -> DataFrame:
    """A15 from long detections (photo_id, name, confidence)."""
    sure = F.col("confidence") >= threshold
    agg = detections.groupBy("photo_id").agg(
        F.sum(F.when((F.col("name") == "plastic") & sure, 1).otherwise(0)).cast("int").alias("plastic"),
        F.sum(F.when((F.col("name") == "label") & sure, 1).otherwise(0)).cast("int").alias("label"))
    return _score(agg)


def photo_points_from_array(photos: DataFrame, col: str = "detections",
                            threshold: float = S.DETECTION_THRESHOLD) -> DataFrame:
    """A15 + F9 when each photo carries ``array<struct<name, confidence>>``:
    higher-order filters, no explode."""
    def n(name: str) -> Column:
        return F.size(F.filter(col, lambda d: (d["name"] == name) & (d["confidence"] >= threshold)))
    return _score(photos.select("photo_id", n("plastic").alias("plastic"), n("label").alias("label")))


def _score(agg: DataFrame) -> DataFrame:
    verdict = (F.when(F.col("plastic") < 1, "ModelNoPlastic")
               .when(F.col("label") >= 1, "ModelYesLabel").otherwise(ACCEPTED))
    pts = F.when(verdict == ACCEPTED, F.col("plastic") * 10).otherwise(0).cast("int")
    return agg.withColumn("verdict", verdict).withColumn("points", pts)


# ---------------------------------------------------------------------------
# Ledger (A19) and the retraining manifest
# ---------------------------------------------------------------------------
def points_ledger(logs: DataFrame, time_col: str = "ts") -> DataFrame:
    """A19, batch form: points per member and month from the point events."""
    pts = logs.filter(F.col("key").isin("1", "2") & (F.col("member_id") != S.VISITOR))
    return pts.groupBy("member_id", F.date_format(time_col, "yyyy-MM").alias("month_kb")) \
              .agg(F.sum("save_point").cast("bigint").alias("point_amt"))


def ledger_sums(parts: DataFrame) -> DataFrame:
    """Partial ledgers added up per member and month."""
    return parts.groupBy("member_id", "month_kb").agg(F.sum("point_amt").cast("bigint").alias("point_amt"))


def ledger_upsert(ledger: DataFrame, new_points: DataFrame) -> DataFrame:
    """A19, incremental form: add new (member_id, month_kb, point_amt) rows to
    the ledger; a key already present is updated, a new one inserted."""
    cols = ["member_id", "month_kb", "point_amt"]
    return ledger_sums(ledger.select(*cols).unionByName(new_points.select(*cols)))


def training_manifest(uploads: DataFrame, results: DataFrame) -> DataFrame:
    """Every stored upload with its model result when there is one."""
    stored = uploads.filter(F.col("pic_time").isNotNull()) \
                    .select("event_id", "member_id", "pic_time")
    j = stored.join(results.select("member_id", "pic_time", "result_id"),
                    ["member_id", "pic_time"], "left")
    return j.withColumn("has_result", F.col("result_id").isNotNull())
