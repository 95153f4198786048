"""Dashboard answers, computed from the hourly and search tables.

The reference pulls one day of keys into a single pandas process and
recomputes ~20 groupings there. Here each answer is a grouped DataFrame over
the keyed tables, with ``date`` kept as a grouping column so one job serves
every day; selecting a day is a filter on that column. All inputs are
already aggregates (one row per segment-hour), so every shuffle below moves
small partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions import scalars as S

MENU_METRICS = ["menu_eco1", "menu_eco2", "menu_nolabel", "menu_lesswaste"]
NOLABEL_METRICS = ["nolabel_click", "nolabel_search"]
# (service label, use metric, menu metric)
DEMAND = (
    ("ecopoint1", "ecopoint1_click", "menu_eco1"),
    ("ecopoint2", "ecopoint2_click", "menu_eco2"),
    ("nolabel", "nolabel_click", "menu_nolabel"),
    ("lesswaste", "lesswaste_click", "menu_lesswaste"),
)
FILTER_DIMENSIONS = ["hour", "user_age", "user_gender", "user_region"]


def _sum(c: str, alias: str | None = None) -> Column:
    return F.sum(c).cast("bigint").alias(alias or c)


# ---------------------------------------------------------------------------
# Filters and their option lists
# ---------------------------------------------------------------------------
def dash_filter(hourly: DataFrame, hours: Sequence[int] | None = None,
                ages: Sequence[int] | None = None, genders: Sequence[str] | None = None,
                regions: Sequence[str] | None = None) -> DataFrame:
    """conjunction of list memberships; a missing list means all values."""
    cond = F.lit(True)
    for col, values in (("hour", hours), ("user_age", ages), ("user_gender", genders),
                        ("user_region", regions)):
        if values is not None:
            cond = cond & F.col(col).isin(list(values))
    return hourly.filter(cond)


def dash_filter_search(search: DataFrame, ages: Sequence[int] | None = None,
                       genders: Sequence[str] | None = None) -> DataFrame:
    """the search table filtered with the age and gender lists."""
    cond = F.lit(True)
    if ages is not None:
        cond = cond & F.col("age").isin(list(ages))
    if genders is not None:
        cond = cond & F.col("gender").isin(list(genders))
    return search.filter(cond)


def filter_options(hourly: DataFrame) -> DataFrame:
    """distinct values offered for each filter, per day (long form)."""
    stacked = hourly.select(
        "date",
        F.explode(F.array(*[F.struct(F.lit(d).alias("option"),
                                     F.col(d).cast("string").alias("value"))
                            for d in FILTER_DIMENSIONS])).alias("o"))
    return stacked.select("date", "o.option", "o.value").distinct()


# ---------------------------------------------------------------------------
# Group sums and the arg-max
# ---------------------------------------------------------------------------
def inout_by_hour(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("date", "hour").agg(_sum("login"), _sum("logout"))


def login_by(hourly: DataFrame, dim: str) -> DataFrame:
    return hourly.groupBy("date", dim).agg(_sum("login"))


def peak_login(hourly: DataFrame, dims: Sequence[str] = ("hour", "user_age", "user_region")) -> DataFrame:
    """A5: per day and dimension, the value with the most logins; ties go to the
    smallest value. The dimensions are stacked into (dimension, value) rows and
    summed in one aggregation; each (day, dimension) then has a handful of
    values, so the window sorts tiny partitions."""
    stacked = hourly.select(
        "date", "login",
        F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"),
                                     F.col(d).cast("string").alias("value"))
                            for d in dims])).alias("d"))
    sums = stacked.groupBy("date", "d.dimension", "d.value").agg(_sum("login"))
    # Numbers compare as numbers: hour 9 comes before hour 10.
    w = Window.partitionBy("date", "dimension").orderBy(
        F.desc("login"), F.col("value").try_cast("bigint").asc_nulls_last(), F.asc("value"))
    return sums.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def points_by_hour(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("date", "hour").agg(_sum("save_ecopoint1"), _sum("save_ecopoint2"))


# ---------------------------------------------------------------------------
# Wide to long
# ---------------------------------------------------------------------------
def _long(df: DataFrame, ids: list[str], metrics: list[str], name: str, value: str,
          label_upper: bool) -> DataFrame:
    long = df.unpivot(ids, metrics, name, value)
    label = S.metric_label(name) if label_upper else F.split(F.col(name), "_").getItem(1)
    return long.withColumn(name, label)


def menu_by(hourly: DataFrame, dims: list[str]) -> DataFrame:
    """Menu clicks per dimension values, one row per menu."""
    agg = hourly.groupBy("date", *dims).agg(*[_sum(m) for m in MENU_METRICS])
    return _long(agg, ["date", *dims], MENU_METRICS, "menu", "click", True)


def nolabel_by_hour(hourly: DataFrame) -> DataFrame:
    """Product searches against clicks per hour."""
    agg = hourly.groupBy("date", "hour").agg(*[_sum(m) for m in NOLABEL_METRICS])
    return _long(agg, ["date", "hour"], NOLABEL_METRICS, "type", "count", False)


# ---------------------------------------------------------------------------
# Ratios and shares
# ---------------------------------------------------------------------------
def demand_ratios(hourly: DataFrame) -> DataFrame:
    """A10: percent of menu visits that used the service, half-to-even rounding,
    null when the menu was never opened."""
    metrics = sorted({m for _, a, b in DEMAND for m in (a, b)})
    agg = hourly.groupBy("date").agg(*[_sum(m) for m in metrics])
    rows = F.array(*[F.struct(F.lit(s).alias("service"), F.col(a).alias("used"),
                              F.col(b).alias("visits")) for s, a, b in DEMAND])
    long = agg.select("date", F.explode(rows).alias("r")).select("date", "r.*")
    pct = F.bround(F.try_divide(F.col("used"), F.col("visits")) * 100, 0).cast("bigint")
    return long.withColumn("percent", pct)


def login_share_gender(hourly: DataFrame) -> DataFrame:
    """Share of the day's logins by gender."""
    g = hourly.groupBy("date", "user_gender").agg(_sum("login"))
    total = F.sum("login").over(Window.partitionBy("date"))
    return g.withColumn("share", F.try_divide(F.col("login"), total))


def visitor_share(hourly: DataFrame) -> DataFrame:
    """Product clicks by members against visitors."""
    visitor = F.col("user_gender") == S.VISITOR
    agg = hourly.groupBy("date").agg(
        F.sum(F.when(~visitor, F.col("nolabel_click")).otherwise(0)).cast("bigint").alias("users"),
        F.sum(F.when(visitor, F.col("nolabel_click")).otherwise(0)).cast("bigint").alias("visitors"))
    return agg.withColumn("user_share",
                          F.try_divide(F.col("users"), F.col("users") + F.col("visitors")))


# ---------------------------------------------------------------------------
# Hierarchical totals
# ---------------------------------------------------------------------------
def menu_rollup(hourly: DataFrame) -> DataFrame:
    """Totals at every level of date > gender > age > menu."""
    long = menu_by(hourly, ["user_gender", "user_age"])
    return long.rollup("date", "user_gender", "user_age", "menu").agg(
        _sum("click"), F.grouping_id().cast("int").alias("level"))


def search_rollup(search: DataFrame) -> DataFrame:
    """Totals at every level of date > gender > age > word."""
    return search.rollup("date", "gender", "age", "word").agg(
        _sum("count"), F.grouping_id().cast("int").alias("level"))


# ---------------------------------------------------------------------------
# points
# ---------------------------------------------------------------------------
def member_points(hourly: DataFrame) -> DataFrame:
    """Member segments only, with both services' points added."""
    return hourly.filter(F.col("user_gender") != S.VISITOR).withColumn(
        "save_ecopoint", F.col("save_ecopoint1") + F.col("save_ecopoint2"))


def points_by(hourly: DataFrame, dim: str) -> DataFrame:
    return member_points(hourly).groupBy("date", "hour", dim).agg(_sum("save_ecopoint"))


def hour_quartiles(hourly: DataFrame) -> DataFrame:
    """Quartiles of the hour over member segment rows, per day and gender. The
    exact percentile keeps a value->count map, bounded by the 24 hours."""
    q = F.percentile(F.col("hour"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    agg = member_points(hourly).groupBy("date", "user_gender").agg(q.alias("q"))
    return agg.select("date", "user_gender", F.col("q")[0].alias("q1"),
                      F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))


def points_scatter(hourly: DataFrame) -> DataFrame:
    """Per segment row, both services' points with the age band."""
    return hourly.select("date", "hour", F.col("user_age").cast("int").alias("user_age"),
                         "user_gender", "user_region", "save_ecopoint1", "save_ecopoint2")
