"""The three log jobs: hourly segment metrics, daily search counts, daily clicks.

Each takes a flattened log DataFrame (the ``logs`` adapter in batch, the
decoded bus stream in Structured Streaming) and returns the aggregate.
Grouping uses the window struct itself; ``hour`` and ``date`` are derived
from ``window.start`` after the aggregate, so they are not extra grouping
keys. Hash aggregation runs partial-then-final, which absorbs the hot
visitor segment before the shuffle.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions import scalars as S

# (metric, predicate column, predicate value, value summed when it holds)
HOURLY_METRICS = (
    ("login", "key", "login", None),
    ("logout", "key", "logout", None),
    ("menu_nolabel", "selected_menu", "nolabel", None),
    ("menu_eco1", "selected_menu", "ecopoint1", None),
    ("menu_eco2", "selected_menu", "ecopoint2", None),
    ("menu_lesswaste", "selected_menu", "lesswaste", None),
    ("ecopoint1_click", "key", "1", None),
    ("ecopoint2_click", "key", "2", None),
    ("lesswaste_click", "key", "lesswaste", None),
    ("nolabel_search", "key", "search", None),
    ("nolabel_click", "key", "click", None),
    ("save_ecopoint1", "key", "1", "save_point"),
    ("save_ecopoint2", "key", "2", "save_point"),
)
METRIC_NAMES = [m[0] for m in HOURLY_METRICS]
SEGMENT_KEYS = ["date", "hour", "user_age", "user_region", "user_gender"]


def _metric(name: str, col: str, value: str, summed: str | None) -> Column:
    hit = F.col(col) == value
    amount = F.lit(1) if summed is None else F.col(summed)
    return F.sum(F.when(hit, amount).otherwise(0)).cast("bigint").alias(name)


def flatten_events(logs: DataFrame, time_col: str = "ts",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """The projection the hourly job works on (``keep``: passthrough
    columns such as an event id)."""
    return logs.select(
        *keep,
        F.col(time_col).alias("ts"),
        F.hour(time_col).alias("hour"),
        "key",
        S.age_band_hourly("user_age").alias("user_age"),
        "user_gender", "user_region", "save_point", "selected_menu",
        "search_word", "product_name",
    )


def common_hourly_windows(logs: DataFrame, time_col: str = "ts") -> DataFrame:
    """A1 keyed by the 60-minute window struct (the streaming form groups on this)."""
    flat = logs.select(
        F.col(time_col).alias("ts"), "key", "selected_menu", "save_point",
        S.age_band_hourly("user_age").alias("user_age"), "user_region", "user_gender")
    return flat.groupBy(F.window("ts", "60 minutes").alias("window"),
                        "user_age", "user_region", "user_gender") \
               .agg(*[_metric(*m) for m in HOURLY_METRICS])


def with_day_hour(agg: DataFrame) -> DataFrame:
    return agg.select(
        S.day_text(F.col("window.start")).alias("date"),
        F.hour(F.col("window.start")).alias("hour"),
        "user_age", "user_region", "user_gender", *METRIC_NAMES)


def common_hourly(logs: DataFrame, time_col: str = "ts") -> DataFrame:
    """A1: 13 conditional sums per (hour window, age band, region, gender)."""
    return with_day_hour(common_hourly_windows(logs, time_col))


# ---------------------------------------------------------------------------
# Search (A2) and its inputs
# ---------------------------------------------------------------------------
def search_events(logs: DataFrame, time_col: str = "ts") -> DataFrame:
    """F1 + shaping: the four columns the daily search count needs."""
    return logs.filter(F.col("key") == "search").select(
        F.col(time_col).alias("ts"),
        S.gender_norm("user_gender").alias("gender"),
        S.age_band_search("user_age").alias("age"),
        F.col("search_word").alias("word"))


def search_daily_windows(searches: DataFrame) -> DataFrame:
    return searches.groupBy(F.window("ts", "1440 minutes").alias("window"),
                            "gender", "age", "word").count()


def search_daily(logs: DataFrame, time_col: str = "ts") -> DataFrame:
    """A2: count per (day window, gender, age band, word)."""
    agg = search_daily_windows(search_events(logs, time_col))
    return agg.select(S.day_text(F.col("window.start")).alias("date"),
                      "gender", "age", "word", F.col("count").cast("bigint").alias("count"))


# ---------------------------------------------------------------------------
# Clicks (A3) and the bounded scan
# ---------------------------------------------------------------------------
def scan_partition(logs: DataFrame, topic: str, partition: int) -> DataFrame:
    """S3: one partition of one topic. ``topic``/``partition`` are real columns,
    so the predicate reaches the parquet scan."""
    return logs.filter((F.col("topic") == topic) & (F.col("partition") == partition))


def lookback_bounds(as_of: str, start_hours: int = 29, end_hours: int = 5):
    t = datetime.fromisoformat(as_of)
    return t - timedelta(hours=start_hours), t - timedelta(hours=end_hours)


def lookback(logs: DataFrame, as_of: str, time_col: str = "ts",
             start_hours: int = 29, end_hours: int = 5) -> DataFrame:
    """``[as_of - 29 h, as_of - 5 h)``, a literal range on the time column."""
    lo, hi = lookback_bounds(as_of, start_hours, end_hours)
    # Text literals parsed as timestamp_ntz: independent of the session zone
    # (a Python datetime literal would be shifted by it).
    lo_c = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
    hi_c = F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")
    return logs.filter((F.col(time_col) >= lo_c) & (F.col(time_col) < hi_c))


def click_events(logs: DataFrame, time_col: str = "ts", keep_unmatched: bool = False) -> DataFrame:
    """the click payload. The reference decodes only rows keyed ``click``
    but keeps the rest as all-null rows; ``keep_unmatched`` reproduces that."""
    is_click = F.col("key") == "click"
    src = logs if keep_unmatched else logs.filter(is_click)

    def only(c: str) -> Column:
        return F.when(is_click, F.col(c)) if keep_unmatched else F.col(c)

    return src.select(
        only(time_col).alias("productclick_time"),
        only("member_id").alias("member_id"),
        only("user_gender").alias("user_gender"),
        only("user_age").alias("user_age"),
        only("user_region").alias("user_region"),
        only("product_name").alias("product_name"),
        only("product_volume").alias("product_volume"),
        only("product_unitprice").alias("product_unitprice"))


CLICK_KEYS = ["date", "product_name", "product_volume", "user_age", "user_gender"]


def click_daily(logs: DataFrame, as_of: str, time_col: str = "ts",
                sort: bool = True) -> DataFrame:
    """A3: min price and count per (day, product, volume, age band, gender)
    over the closed-day lookback of partition 1 of ``log_nolabel``."""
    src = lookback(scan_partition(logs, "log_nolabel", 1), as_of, time_col)
    clicks = click_events(src, time_col).select(
        S.day_text("productclick_time").alias("date"),
        "product_name", "product_volume",
        S.age_band_click("user_age").alias("user_age"),
        "user_gender",
        S.parse_price("product_unitprice").alias("price"))
    agg = clicks.groupBy(*CLICK_KEYS).agg(
        F.min("price").alias("price_min"), F.count(F.lit(1)).alias("count"))
    return agg.orderBy(*CLICK_KEYS) if sort else agg
