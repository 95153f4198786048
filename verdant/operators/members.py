"""Member answers: totals, grades, month comparison, popular words, sign-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions import scalars as S


def enrich_events(events: DataFrame, members: DataFrame, as_of: str,
                  visitor: Column | None = None, id_col: str = "user_id") -> DataFrame:
    """Events with the member attributes the logs carry (gender, logged
    age as text, region). Visitors and ids without a member get ``none``.
    No hint: the planner broadcasts the member side only when its size
    estimate allows, else both sides shuffle on the id (AQE splits hot ids)."""
    m = members.select(F.col("user_id").alias("_uid"), "member_id", "gender_kb", "region_kb",
                       S.logged_age("birth_dt", F.lit(as_of).cast("date")).alias("_age"))
    j = events.join(m, F.col(id_col) == F.col("_uid"), "left")
    anon = F.col("_uid").isNull() if visitor is None else (visitor | F.col("_uid").isNull())

    def field(c: Column) -> Column:
        return F.when(anon, F.lit(S.VISITOR)).otherwise(c)

    return j.select("event_id", id_col,
                    field(F.col("member_id")).alias("member_id"),
                    field(F.col("gender_kb")).alias("user_gender"),
                    field(F.col("_age").cast("string")).alias("user_age"),
                    field(F.col("region_kb")).alias("user_region"))


def member_age(members: DataFrame, as_of: str) -> DataFrame:
    """P20: the age written into the logs at ``as_of``."""
    return members.select("member_id", "birth_dt",
                          S.logged_age("birth_dt", F.lit(as_of).cast("date")).alias("user_age"))


def member_total(ledger: DataFrame) -> DataFrame:
    """Total points per member."""
    return ledger.groupBy("member_id").agg(F.sum("point_amt").cast("bigint").alias("total"))


def member_grade(members: DataFrame, ledger: DataFrame) -> DataFrame:
    """P31 + K23: grade and temperature; a member without points is grade 0."""
    totals = member_total(ledger)
    j = members.select("member_id").join(totals, "member_id", "left")
    total = F.coalesce(F.col("total"), F.lit(0)).cast("bigint")
    return j.select("member_id", total.alias("total"), S.grade(total).alias("grade"),
                    S.temperature(total).alias("temp"))


def month_window(as_of: str, months_back: int = 3):
    d = F.lit(as_of).cast("date")
    return (F.date_format(F.add_months(d, -months_back), "yyyy-MM"), F.date_format(d, "yyyy-MM"))


def member_vs_all(ledger: DataFrame, members: DataFrame, as_of: str,
                  months_back: int = 3) -> DataFrame:
    """A16 + J4: each member's points per month over the current and previous
    ``months_back`` months (a zero row for the current month when there is
    none), beside the average over all members for that month."""
    lo, hi = month_window(as_of, months_back)
    recent = ledger.filter(F.col("month_kb").between(lo, hi))
    avg = recent.groupBy("month_kb").agg(F.avg("point_amt").alias("avg_point_amt"))
    own = recent.select("member_id", "month_kb", F.col("point_amt").cast("bigint"))
    empty = members.select("member_id").join(recent.select("member_id"), "member_id", "left_anti") \
                   .select("member_id", hi.alias("month_kb"), F.lit(0).cast("bigint").alias("point_amt"))
    return own.unionByName(empty).join(avg, "month_kb", "left")


def top_words(search: DataFrame, by: str, k: int = 5) -> DataFrame:
    """The ``k`` most searched words per day and ``by`` (age band or
    gender), counts summed over the other dimension; ties by word. The filter
    on ``row_number`` lets Spark keep only ``k`` rows per group in each map
    partition before the shuffle."""
    sums = search.groupBy("date", by, "word").agg(F.sum("count").cast("bigint").alias("count"))
    w = Window.partitionBy("date", by).orderBy(F.desc("count"), F.asc("word"))
    return sums.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def member_top_words(members: DataFrame, top: DataFrame, day: str, by: str,
                     as_of: str) -> DataFrame:
    """Each member's list for the day, joined on the member's age band
    (logged-age rule, K15) or gender."""
    m = members.select("member_id", F.col("gender_kb").alias("gender"),
                       S.age_band_of(S.logged_age("birth_dt", F.lit(as_of).cast("date"))).alias("age"))
    t = top.filter(F.col("date") == day).select(by, "word", "count", "rank")
    # Bands and genders come from log text, so their number has no bound: the
    # planner broadcasts this side while it is small.
    return m.select("member_id", by).join(t, by)


def signup_check(signups: DataFrame, id_col: str = "user_id") -> DataFrame:
    """F8: a sign-up whose id already exists (an earlier sign-up) is rejected
    (``id_check`` 0); the first one creates the member (1)."""
    first = signups.groupBy(id_col).agg(F.min(F.struct("ts", "event_id")).alias("first"))
    j = signups.join(first, id_col)
    created = F.struct("ts", "event_id") == F.col("first")
    return j.select("event_id", id_col, F.when(created, 1).otherwise(0).alias("id_check"))
