"""Dashboard queries (F3-F5, A4-A14b) over the hourly and search tables."""

from __future__ import annotations

from verdant.operators import dashboard as db
from verdant.operators import segments as seg
from verdant.plans.q_segments import COMMON_HOURLY_SQL, SEARCH_DAILY_SQL
from verdant.plans.registry import register
from verdant.plans.sql_views import with_views
from verdant.sources import fixtures as fx

# Filter lists of the dashboard query (the sidebar selection).
FILTER_HOURS = list(range(9, 19))
FILTER_AGES = [-10, 20, 30, 40]
FILTER_GENDERS = ["W", "none"]
FILTER_REGIONS = ["ASIA", "EUROPE", "none"]
SEARCH_AGES = [20, 30, 40, 99]
SEARCH_GENDERS = ["W", "M", "un"]


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def hourly(spark, d):
    return seg.common_hourly(fx.logs(spark, d, parts=False))


def search(spark, d):
    return seg.search_daily(fx.logs(spark, d, types=("view",)))


def on_hourly(body: str) -> str:
    return with_views(body, "logs", extra={"hourly": COMMON_HOURLY_SQL})


def on_search(body: str) -> str:
    return with_views(body, "logs", extra={"search": SEARCH_DAILY_SQL})


@register("dash_filter", on_hourly(f"""
SELECT * FROM hourly WHERE hour IN ({_in(FILTER_HOURS)}) AND user_age IN ({_in(FILTER_AGES)})
  AND user_gender IN ({_in(FILTER_GENDERS)}) AND user_region IN ({_in(FILTER_REGIONS)})"""))
def q_dash_filter(spark, d):
    return db.dash_filter(hourly(spark, d), FILTER_HOURS, FILTER_AGES, FILTER_GENDERS,
                          FILTER_REGIONS)


@register("dash_filter_search", on_search(f"""
SELECT * FROM search WHERE age IN ({_in(SEARCH_AGES)}) AND gender IN ({_in(SEARCH_GENDERS)})"""))
def q_dash_filter_search(spark, d):
    return db.dash_filter_search(search(spark, d), SEARCH_AGES, SEARCH_GENDERS)


@register("filter_options", on_hourly("\nUNION\n".join(
    f"SELECT DISTINCT date, '{c}' AS option, CAST({c} AS VARCHAR) AS value FROM hourly"
    for c in db.FILTER_DIMENSIONS)))
def q_filter_options(spark, d):
    return db.filter_options(hourly(spark, d))


@register("inout_by_hour", on_hourly("""
SELECT date, hour, CAST(sum(login) AS BIGINT) AS login, CAST(sum(logout) AS BIGINT) AS logout
FROM hourly GROUP BY 1, 2"""))
def q_inout_by_hour(spark, d):
    return db.inout_by_hour(hourly(spark, d))


@register("login_by_age", on_hourly("""
SELECT date, user_age, CAST(sum(login) AS BIGINT) AS login FROM hourly GROUP BY 1, 2"""))
def q_login_by_age(spark, d):
    return db.login_by(hourly(spark, d), "user_age")


@register("login_by_gender", on_hourly("""
SELECT date, user_gender, CAST(sum(login) AS BIGINT) AS login FROM hourly GROUP BY 1, 2"""))
def q_login_by_gender(spark, d):
    return db.login_by(hourly(spark, d), "user_gender")


@register("peak_login", on_hourly("""
SELECT date, value, login, dimension FROM (
  SELECT *, row_number() OVER (PARTITION BY date, dimension ORDER BY login DESC, TRY_CAST(value AS BIGINT) ASC NULLS LAST, value ASC) AS rn
  FROM (""" + "\n    UNION ALL\n".join(
    f"    SELECT date, CAST({c} AS VARCHAR) AS value, CAST(sum(login) AS BIGINT) AS login,"
    f" '{c}' AS dimension FROM hourly GROUP BY 1, 2"
    for c in ("hour", "user_age", "user_region")) + """)) WHERE rn = 1"""))
def q_peak_login(spark, d):
    return db.peak_login(hourly(spark, d))


@register("points_by_hour", on_hourly("""
SELECT date, hour, CAST(sum(save_ecopoint1) AS BIGINT) AS save_ecopoint1,
  CAST(sum(save_ecopoint2) AS BIGINT) AS save_ecopoint2 FROM hourly GROUP BY 1, 2"""))
def q_points_by_hour(spark, d):
    return db.points_by_hour(hourly(spark, d))


def _menu_body(dims: list[str]) -> str:
    ds = ", ".join(dims)
    sums = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in db.MENU_METRICS)
    return f"""
SELECT date, {ds}, upper(split_part(menu, '_', 2)) AS menu, click FROM (
  UNPIVOT (SELECT date, {ds}, {sums} FROM hourly GROUP BY ALL)
  ON {', '.join(db.MENU_METRICS)} INTO NAME menu VALUE click)"""


def _menu_sql(dims: list[str]) -> str:
    return on_hourly(_menu_body(dims))


@register("menu_by_age", _menu_sql(["user_age"]))
def q_menu_by_age(spark, d):
    return db.menu_by(hourly(spark, d), ["user_age"])


@register("menu_by_gender_age", _menu_sql(["user_gender", "user_age"]))
def q_menu_by_gender_age(spark, d):
    return db.menu_by(hourly(spark, d), ["user_gender", "user_age"])


@register("nolabel_by_hour", on_hourly("""
SELECT date, hour, split_part(type, '_', 2) AS type, count FROM (
  UNPIVOT (SELECT date, hour, CAST(sum(nolabel_click) AS BIGINT) AS nolabel_click,
                  CAST(sum(nolabel_search) AS BIGINT) AS nolabel_search FROM hourly GROUP BY ALL)
  ON nolabel_click, nolabel_search INTO NAME type VALUE count)"""))
def q_nolabel_by_hour(spark, d):
    return db.nolabel_by_hour(hourly(spark, d))


@register("demand_ratios", on_hourly("\nUNION ALL\n".join(
    f"""SELECT date, '{s}' AS service, CAST(sum({a}) AS BIGINT) AS used,
  CAST(sum({b}) AS BIGINT) AS visits,
  CAST(CASE WHEN sum({b}) = 0 THEN NULL
       ELSE round_even(CAST(sum({a}) AS DOUBLE) / CAST(sum({b}) AS DOUBLE) * 100, 0) END
       AS BIGINT) AS percent
FROM hourly GROUP BY date""" for s, a, b in db.DEMAND)))
def q_demand_ratios(spark, d):
    return db.demand_ratios(hourly(spark, d))


@register("login_share_gender", on_hourly("""
SELECT date, user_gender, login,
  CASE WHEN sum(login) OVER (PARTITION BY date) = 0 THEN NULL
       ELSE CAST(login AS DOUBLE) / CAST(sum(login) OVER (PARTITION BY date) AS DOUBLE) END AS share
FROM (SELECT date, user_gender, CAST(sum(login) AS BIGINT) AS login FROM hourly GROUP BY 1, 2)"""))
def q_login_share_gender(spark, d):
    return db.login_share_gender(hourly(spark, d))


@register("visitor_share", on_hourly("""
SELECT date, users, visitors,
  CASE WHEN users + visitors = 0 THEN NULL
       ELSE CAST(users AS DOUBLE) / CAST(users + visitors AS DOUBLE) END AS user_share
FROM (SELECT date,
  CAST(sum(CASE WHEN user_gender <> 'none' THEN nolabel_click ELSE 0 END) AS BIGINT) AS users,
  CAST(sum(CASE WHEN user_gender = 'none' THEN nolabel_click ELSE 0 END) AS BIGINT) AS visitors
  FROM hourly GROUP BY date)"""))
def q_visitor_share(spark, d):
    return db.visitor_share(hourly(spark, d))


@register("menu_rollup", with_views("""
SELECT date, user_gender, user_age, menu, CAST(sum(click) AS BIGINT) AS click,
  CAST(GROUPING(date, user_gender, user_age, menu) AS INTEGER) AS level
FROM menu_long GROUP BY ROLLUP (date, user_gender, user_age, menu)""", "logs", extra={
    "hourly": COMMON_HOURLY_SQL, "menu_long": _menu_body(["user_gender", "user_age"])}))
def q_menu_rollup(spark, d):
    return db.menu_rollup(hourly(spark, d))


@register("search_rollup", on_search("""
SELECT date, gender, age, word, CAST(sum(count) AS BIGINT) AS count,
  CAST(GROUPING(date, gender, age, word) AS INTEGER) AS level
FROM search GROUP BY ROLLUP (date, gender, age, word)"""))
def q_search_rollup(spark, d):
    return db.search_rollup(search(spark, d))


def _points_sql(dim: str) -> str:
    return on_hourly(f"""
SELECT date, hour, {dim}, CAST(sum(save_ecopoint1 + save_ecopoint2) AS BIGINT) AS save_ecopoint
FROM hourly WHERE user_gender <> 'none' GROUP BY 1, 2, 3""")


@register("points_by_region", _points_sql("user_region"))
def q_points_by_region(spark, d):
    return db.points_by(hourly(spark, d), "user_region")


@register("points_by_gender", _points_sql("user_gender"))
def q_points_by_gender(spark, d):
    return db.points_by(hourly(spark, d), "user_gender")


@register("hour_quartiles", on_hourly("""
SELECT date, user_gender, quantile_cont(hour, 0.25) AS q1, quantile_cont(hour, 0.5) AS median,
  quantile_cont(hour, 0.75) AS q3
FROM hourly WHERE user_gender <> 'none' GROUP BY 1, 2"""))
def q_hour_quartiles(spark, d):
    return db.hour_quartiles(hourly(spark, d))


@register("points_scatter", on_hourly("""
SELECT date, hour, CAST(user_age AS INTEGER) AS user_age, user_gender, user_region,
  save_ecopoint1, save_ecopoint2 FROM hourly"""))
def q_points_scatter(spark, d):
    return db.points_scatter(hourly(spark, d))
