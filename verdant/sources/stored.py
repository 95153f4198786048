"""Folders of Parquet that jobs keep up to date: a points ledger that applies
each batch once, the warm tier with its retention, the bus archive and the
sorted serving table. Plain partitioned writes and filtered reads; what a
re-run writes replaces what it wrote before.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators import points as pt

LEDGER_KEYS = ["member_id", "month_kb"]
LEDGER_DDL = "member_id string, month_kb string, point_amt bigint"


def _files(spark: SparkSession, pattern: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return [f.getPath().toString() for f in found or []]


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Write ``df``, replacing the partitions it holds and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


# ---------------------------------------------------------------------------
# The ledger, batch by batch
# ---------------------------------------------------------------------------
def apply_points(logs: DataFrame, path: str, batch_id: int, writer: str = "direct", time_col: str = "ts") -> None:
    """Add the points of one batch of events. Its sums per member and month lie
    in a folder named by writer and batch, so a batch that is applied again
    replaces itself and counts once. A writer is one stream (its checkpoint)."""
    sums = pt.points_ledger(logs, time_col)
    sums.write.mode("overwrite").parquet(f"{path}/batches/writer={writer}/batch_id={int(batch_id)}")


def _folded(spark: SparkSession, path: str) -> dict[str, int]:
    """Writer -> last batch of its newest finished fold."""
    out: dict[str, int] = {}
    for f in _files(spark, f"{path}/folded/writer=*/upto=*/_SUCCESS"):
        writer, upto = re.search(r"writer=([^/]+)/upto=(\d+)/_SUCCESS$", f).groups()
        out[writer] = max(out.get(writer, -1), int(upto))
    return out


def _parts(spark: SparkSession, path: str, writer: str | None = None, upto: int | None = None) -> DataFrame:
    """The sums to add up: each writer's newest fold and its batches behind it."""
    folded = _folded(spark, path)
    out = spark.createDataFrame([], LEDGER_DDL)
    folders = [(w, n) for w, n in folded.items() if writer in (None, w)]
    for w, n in folders:
        out = out.unionByName(spark.read.schema(LEDGER_DDL).parquet(f"{path}/folded/writer={w}/upto={n}"))
    if _files(spark, f"{path}/batches/writer=*"):
        batches = spark.read.schema(LEDGER_DDL + ", writer string, batch_id bigint").parquet(f"{path}/batches")
        if writer is not None:
            batches = batches.filter((F.col("writer") == writer) & (F.col("batch_id") <= upto))
        for w, n in folders:
            batches = batches.filter(~((F.col("writer") == w) & (F.col("batch_id") <= n)))
        out = out.unionByName(batches.select("member_id", "month_kb", "point_amt"))
    return out


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Points per member and month over all batches applied so far."""
    return pt.ledger_sums(_parts(spark, path))


def fold_ledger(spark: SparkSession, path: str, writer: str, upto: int) -> None:
    """Add a writer's batches up to ``upto`` into one folder, so that readers
    open few files. Batches that a fold holds no longer count, so one of them
    applied again changes nothing; an unfinished fold isn't read."""
    done = _folded(spark, path).get(writer, -1)
    if upto > done:
        pt.ledger_sums(_parts(spark, path, writer, upto)).write.mode("overwrite") \
            .parquet(f"{path}/folded/writer={writer}/upto={int(upto)}")


# ---------------------------------------------------------------------------
# The warm tier
# ---------------------------------------------------------------------------
def append_warm(hourly: DataFrame, path: str, last_day: str, days: int = 7) -> None:
    """Store the days of ``hourly`` (each replaces what was stored for it) and
    drop the folders of days before the last ``days`` up to ``last_day``."""
    spark = hourly.sparkSession
    _replace(hourly.hint("rebalance", "date"), path, "date")
    first = spark.range(1).select(F.date_format(F.date_sub(F.to_date(F.lit(last_day), "yyyyMMdd"), days - 1), "yyyyMMdd")).first()[0]
    for folder in _files(spark, f"{path}/date=*"):
        if folder.rsplit("=", 1)[1] < first:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_days(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table stored by day; the day stays text."""
    return spark.read.schema(schema).parquet(path)


# ---------------------------------------------------------------------------
# The bus archive
# ---------------------------------------------------------------------------
def archive_bus(records: DataFrame, path: str, time_col: str = "timestamp") -> None:
    """Bus records in one folder per topic, partition and day. Each day's files
    are cut by size, whatever share of the records one topic holds."""
    out = records.withColumn("date", F.date_format(time_col, "yyyyMMdd"))
    _replace(out.hint("rebalance", "topic", "partition", "date"), path, "topic", "partition", "date")


def scan_bus(spark: SparkSession, path: str, schema, topic: str, partition: int, days: tuple[str, str] | None = None) -> DataFrame:
    """The records of one partition of a topic, of the days from one to another:
    topic, partition and day choose folders, nothing else is opened."""
    out = spark.read.schema(schema).parquet(path).filter((F.col("topic") == topic) & (F.col("partition") == partition))
    return out.filter(F.col("date").between(*days)) if days else out


# ---------------------------------------------------------------------------
# O2: the sorted serving table
# ---------------------------------------------------------------------------
SERVING_ORDER = ["user_age", "user_gender", "user_region", "hour"]


def store_serving(hourly: DataFrame, path: str, rows_per_group: int = 20_000) -> None:
    """The hourly table for readers of one day and segment: a folder per day,
    files clustered by range and sorted within, so a segment lies in few row
    groups and the others are skipped by their smallest and largest values."""
    (hourly.repartitionByRange("date", *SERVING_ORDER).sortWithinPartitions("date", *SERVING_ORDER)
     .write.option("parquet.block.row.count.limit", rows_per_group).partitionBy("date").mode("overwrite").parquet(path))


def serve_segment(spark: SparkSession, path: str, schema, day: str, age: int) -> DataFrame:
    """One day's rows of an age band, in serving order."""
    rows = read_days(spark, path, schema).filter((F.col("date") == day) & (F.col("user_age") == age))
    return rows.orderBy(*SERVING_ORDER)
