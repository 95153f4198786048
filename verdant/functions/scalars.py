"""Column expressions shared by the jobs.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen. Dirty text always goes through
``try_cast``: with ANSI mode on, a plain cast of ``'none'`` or ``'1,200'``
fails the whole job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical answers)
# ---------------------------------------------------------------------------
VISITOR = "none"                 # member fields of a visitor
SEARCH_VISITOR_GENDER = "un"     # visitor gender in the search table
AGE_CAP = 60                     # ages at or above this fall into band 60
HOURLY_VISITOR_AGE = -1          # hourly job maps a visitor to -1 (band -10)
SEARCH_UNKNOWN_AGE = 99          # search job: visitor age band
CLICK_UNKNOWN_AGE = 99           # click job: null / unparsable age band
SECOND_PARTITION_KEYS = ("logout", "2", "click")   # keys routed to partition 1
TOPIC_BY_KEY = {                 # event key -> bus topic
    "login": "log_inout",
    "logout": "log_inout",
    "menuclick": "log_menuclick",
    "1": "log_ecopoint",
    "2": "log_ecopoint",
    "search": "log_nolabel",
    "click": "log_nolabel",
    "lesswaste": "log_lesswaste",
    "error": "log_error",
}
# Log-record attributes that never go into the payload.
PAYLOAD_SKIP_FIELDS = (
    "args", "asctime", "created", "exc_info", "exc_text", "filename",
    "funcName", "id", "levelname", "levelno", "lineno", "module",
    "msecs", "msecs", "message", "msg", "name", "pathname", "process",
    "processName", "relativeCreated", "thread", "threadName", "extra",
    "auth_token", "password", "stack_info", "topic", "key")
# Grade bands: total points above the previous bound and at most this bound.
# (upper bound, grade, temperature label); above the last bound: grade 10.
GRADE_BANDS = (
    (10, 0, "14.5°C"),
    (50, 1, "14.4°C"),
    (100, 2, "14.3°C"),
    (200, 3, "14.2°C"),
    (500, 4, "14.1°C"),
    (1000, 5, "14.0°C"),
    (3000, 6, "13.9°C"),
    (10000, 7, "13.8°C"),
    (50000, 8, "13.7°C"),
    (100000, 9, "13.6°C"),
)
TOP_GRADE = (10, "13.5°C")
# Receipt text that earns points (matched after removing spaces).
RECEIPT_KEYWORDS = ("무라벨", "무라밸", "라벨X", "라밸X", "라벨x", "라밸x", "노라밸", "노라벨")
KM_TO_MILE = 0.621371
EARTH_RADIUS_MILES = 3963.2
SESSION_GAP_SECONDS = 1800
UPLOAD_LIMIT_BYTES = 16 * 2 ** 20
DETECTION_THRESHOLD = 0.5
DAILY_CAP = {1: 2, 2: 1}         # accepted uploads per member, day and service
GENDER_LABELS = {"M": "남성", "W": "여성"}   # display labels of the gender codes


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# Age, gender
# ---------------------------------------------------------------------------
def _band(age: Column) -> Column:
    return F.when(age >= AGE_CAP, F.lit(AGE_CAP).cast("bigint")) \
        .otherwise((F.lit(10) * F.floor(age / 10)).cast("bigint"))


def age_band_hourly(age_text) -> Column:
    """Hourly variant: visitor -> -1 -> band -10; null or unparsable -> null."""
    t = _c(age_text)
    age = F.when(t == VISITOR, F.lit(HOURLY_VISITOR_AGE)).otherwise(t.try_cast("int"))
    return _band(age)


def age_band_search(age_text) -> Column:
    """Search variant: visitor -> 99; null or unparsable -> null."""
    t = _c(age_text)
    return F.when(t == VISITOR, F.lit(SEARCH_UNKNOWN_AGE).cast("bigint")) \
        .otherwise(_band(t.try_cast("int")))


def age_band_click(age_text) -> Column:
    """Click variant: anything that is not an integer -> 99."""
    return F.coalesce(_band(_c(age_text).try_cast("int")),
                      F.lit(CLICK_UNKNOWN_AGE).cast("bigint"))


def age_band_of(age) -> Column:
    """Band of an integer age (members' lookup decade, same rule as the logs)."""
    return _band(_c(age))


def gender_norm(gender) -> Column:
    g = _c(gender)
    return F.when(g == VISITOR, F.lit(SEARCH_VISITOR_GENDER)).otherwise(g)


def gender_label(gender) -> Column:
    """Display label of a member gender code (anything but M is W's label)."""
    return F.when(_c(gender) == "M", GENDER_LABELS["M"]).otherwise(GENDER_LABELS["W"])


def logged_age(birth_dt, as_of) -> Column:
    """Age written into the logs: year(as_of) - birth year + 1."""
    birth_year = F.substring(_c(birth_dt), 1, 4).try_cast("int")
    return F.year(_c(as_of)) - birth_year + 1


# ---------------------------------------------------------------------------
# Text and keys
# ---------------------------------------------------------------------------
def parse_price(text) -> Column:
    return _c(text).try_cast("double")


def day_text(ts) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd")


def window_day_text(window_col) -> Column:
    """``yyyyMMdd`` from a window struct the way the reference slices the text
    form of the window (chars 2..9 of ``'{yyyy-MM-dd ...'``, dashes removed)."""
    text = _c(window_col).cast("string")
    return F.regexp_replace(F.substring(text, 2, 10), "-", "")


def composite_key(*parts) -> Column:
    """``a:b:c`` key; null parts become the visitor sentinel so the key is never null."""
    return F.concat_ws(":", *[F.coalesce(_c(p).cast("string"), F.lit(VISITOR)) for p in parts])


def split_key(key, n: int) -> list[Column]:
    """First ``n`` fields of a ``:`` key; the last field keeps any further colons."""
    parts = F.split(_c(key), ":", n)
    return [parts.getItem(i) for i in range(n)]


def metric_label(name) -> Column:
    """``menu_eco1`` -> ``ECO1``: token after the first underscore, upper case."""
    return F.upper(F.split(_c(name), "_").getItem(1))


def remove_spaces(text) -> Column:
    return F.regexp_replace(_c(text), " ", "")


def contains_any(text, keywords) -> Column:
    """True when the space-free text contains any keyword (literal match)."""
    t = remove_spaces(text)
    cond = F.lit(False)
    for kw in keywords:
        cond = cond | F.contains(t, F.lit(kw))
    return cond


# ---------------------------------------------------------------------------
# Routing, payloads
# ---------------------------------------------------------------------------
def route_topic(key) -> Column:
    k = _c(key)
    expr = None
    for name, topic in TOPIC_BY_KEY.items():
        expr = (F.when(k == name, topic) if expr is None else expr.when(k == name, topic))
    return expr


def route_partition(key) -> Column:
    return F.when(_c(key).isin(*SECOND_PARTITION_KEYS), 1).otherwise(0)


def redact(payload, skip=PAYLOAD_SKIP_FIELDS) -> Column:
    """Drop reserved and secret keys from a map column."""
    skip_arr = F.array(*[F.lit(s) for s in dict.fromkeys(skip)])
    return F.map_filter(_c(payload), lambda k, v: ~F.array_contains(skip_arr, k))


def wall_time_text(ts, offset_hours: int = 9) -> Column:
    """Envelope timestamp: epoch time + 9 h, labelled ``Z``, with milliseconds."""
    shifted = _c(ts) + F.make_interval(hours=F.lit(offset_hours))
    return F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# ---------------------------------------------------------------------------
# Points
# ---------------------------------------------------------------------------
def grade(total) -> Column:
    """Grade 0..10 from total points; a member without points is grade 0."""
    t = F.coalesce(_c(total), F.lit(0))
    expr = None
    for bound, g, _ in GRADE_BANDS:
        expr = F.when(t <= bound, g) if expr is None else expr.when(t <= bound, g)
    return expr.otherwise(TOP_GRADE[0])


def temperature(total) -> Column:
    t = F.coalesce(_c(total), F.lit(0))
    expr = None
    for bound, _, temp in GRADE_BANDS:
        expr = F.when(t <= bound, temp) if expr is None else expr.when(t <= bound, temp)
    return expr.otherwise(TOP_GRADE[1])


def receipt_points(id_col, method: str = "mod") -> Column:
    """Repeatable draw of 10, 20, 30, 40 or 50 points for an accepted receipt.

    ``mod`` uses the id itself, ``hash`` an xxhash64 of it; either way a
    retried task gives the same points.
    """
    c = _c(id_col)
    r = F.pmod(F.xxhash64(c), F.lit(5)) if method == "hash" else F.pmod(c, F.lit(5))
    return (F.lit(10) * (F.lit(1) + r)).cast("int")


# ---------------------------------------------------------------------------
# Geo
# ---------------------------------------------------------------------------
def km_to_radians(km) -> Column:
    return _c(km) * F.lit(KM_TO_MILE) / F.lit(EARTH_RADIUS_MILES)


def km_to_radians_value(km: float) -> float:
    return km * KM_TO_MILE / EARTH_RADIUS_MILES


def central_angle(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle angle (radians) between two points given in degrees."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlng = F.radians(_c(lng2)) - F.radians(_c(lng1))
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def bounding_box(lat: float, radius_rad: float) -> tuple[float, float | None]:
    """Half-height and half-width (degrees) of a box that contains the spherical
    cap of ``radius_rad`` around a centre at ``lat``. Width None: all longitudes."""
    dlat = math.degrees(radius_rad)
    c = math.cos(math.radians(lat))
    s = math.sin(radius_rad)
    if s >= c:
        return dlat + 1e-9, None
    return dlat + 1e-9, math.degrees(math.asin(s / c)) + 1e-9
