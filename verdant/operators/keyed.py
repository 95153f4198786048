"""Keyed tables: composite keys, key splitting, last-write-wins reads, unions.

The reference stores aggregates under text keys in a key-value store and
parses the keys back on read. Here dimensions stay columns; the text key is
derived when a sink needs one, and parsed only when a key is all there is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from verdant.functions import scalars as S
from verdant.session import checkpoint_dir

COMMON_KEY_PARTS = ["date", "hour", "user_gender", "user_age", "user_region"]
SEARCH_KEY_PARTS = ["date", "gender", "age", "word"]


def with_key(df: DataFrame, parts: list[str], name: str = "key") -> DataFrame:
    """``a:b:c`` key from dimension columns (null parts -> ``none``)."""
    return df.withColumn(name, S.composite_key(*parts))


def split_keys(df: DataFrame, parts: list[str], key: str = "key") -> DataFrame:
    """Dimension columns (text) from a key; the last part keeps any colon."""
    cols = S.split_key(key, len(parts))
    return df.select("*", *[c.alias(n) for c, n in zip(cols, parts)])


def _numeric_checks(columns: list[str]) -> list:
    return [F.bool_and(F.col(c).isNull() | F.col(c).try_cast(t).isNotNull()).alias(f"{c}__{t}")
            for c in columns for t in ("bigint", "double")]


def _numeric_types(found: dict, columns: list[str]) -> dict[str, str]:
    return {c: "bigint" if found[f"{c}__bigint"] else "double" if found[f"{c}__double"] else "string"
            for c in columns}


def numeric_columns(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Type each text column would take: ``bigint`` or ``double`` when every
    non-null value parses, else it stays ``string``. One aggregate pass."""
    return _numeric_types(df.agg(*_numeric_checks(columns)).first().asDict(), columns)


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cast every text column that is wholly numeric; others keep text.
    The input is computed once: the pass that writes it into the shared folder
    also observes which columns parse, and the cast reads what was written."""
    columns = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not columns:
        return df
    name = f"numeric-{uuid.uuid4().hex}"
    seen, path = Observation(name), f"{checkpoint_dir(df.sparkSession)}/tables/{name}"
    df.observe(seen, *_numeric_checks(columns)).write.parquet(path)
    types = _numeric_types(seen.get, columns)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*[F.col(c).try_cast(types[c]).alias(c) if types.get(c, "string") != "string"
                           else F.col(c) for c in df.columns])


def latest_by_key(df: DataFrame, keys: list[str], version: list[str],
                  values: list[str]) -> DataFrame:
    """Last write wins per key. ``max_by`` is a partial aggregate, so a hot
    key is reduced map-side before the shuffle."""
    v = F.struct(*version)
    picked = F.max_by(F.struct(*values, *version), v).alias("_latest")
    agg = df.groupBy(*keys).agg(picked)
    return agg.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in values + version])


def union_topics(frames: dict[str, DataFrame]) -> DataFrame:
    """Several topic frames as one, columns matched by name, missing ones null."""
    out = None
    for topic, df in frames.items():
        df = df.withColumn("topic", F.lit(topic))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


# Columns each topic carries besides the common member fields.
TOPIC_COLUMNS = {
    "log_inout": [],
    "log_menuclick": ["selected_menu"],
    "log_ecopoint": ["save_point"],
    "log_nolabel": ["search_word", "product_name", "product_volume", "product_unitprice"],
    "log_lesswaste": [],
}
COMMON_COLUMNS = ["event_id", "ts", "key", "member_id", "user_gender", "user_age",
                  "user_region", "partition"]


def select_topics(logs: DataFrame) -> DataFrame:
    """U1 on a source that already holds all topics: the rows that
    ``union_topics`` gives for one frame per topic, in one pass. A column that
    a topic does not carry is null in its rows."""
    carried: dict[str, list[str]] = {}
    for topic, cols in TOPIC_COLUMNS.items():
        for c in cols:
            carried.setdefault(c, []).append(topic)
    extra = [F.when(F.col("topic").isin(topics), F.col(c)).alias(c) for c, topics in carried.items()]
    return logs.filter(F.col("topic").isin(list(TOPIC_COLUMNS))) \
               .select(*COMMON_COLUMNS, *extra, "topic")


def day_range(day: str):
    """``yyyyMMdd`` -> [start, next day) literals, a pushable time predicate."""
    start = F.to_timestamp_ntz(F.lit(day), F.lit("yyyyMMdd"))
    return start, start + F.make_dt_interval(days=F.lit(1))


def scan_day(table: DataFrame, day: str, date_col: str = "date") -> DataFrame:
    """The rows of one day of a keyed table (partition-pruned when the
    table is stored partitioned by ``date``)."""
    return table.filter(F.col(date_col) == day)
