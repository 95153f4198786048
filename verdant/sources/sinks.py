"""Sinks: bus records, CSV exports, the event archive, keyed upsert tables.

Endpoints are parameters. The bus connector jar is optional: without a
``servers`` argument the bus sink writes the same records as JSON files
partitioned by ``partition``, which is also what tests read back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators.keyed import latest_by_key


def write_bus(records: DataFrame, topic: str, path: str | None = None,
              servers: str | None = None, partition: int | None = None) -> None:
    """S9 (+P14): records with ``value`` (and optional ``key``) to a topic.
    Without a partition the bus deals records itself; files lie in the topic's folder.
    ``partition`` pins every record to one partition, as the click job does."""
    out = records
    if partition is not None:
        out = out.withColumn("partition", F.lit(partition))
    if servers:
        (out.write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).save())
        return
    if path is None:
        raise ValueError("either servers or path is required")
    cols = [c for c in ("key", "value", "partition") if c in out.columns]
    folders = [c for c in ("topic", "partition") if c == "topic" or c in cols]
    (out.select(*cols).withColumn("topic", F.lit(topic))
        .write.mode("append").partitionBy(*folders).json(path))


def export_csv(df: DataFrame, path: str) -> None:
    """A filtered frame as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def archive_events(logs: DataFrame, path: str, time_col: str = "ts") -> None:
    """Every event as CSV, one folder per day (appends are safe to rerun
    per day with dynamic partition overwrite)."""
    (logs.withColumn("date", F.date_format(time_col, "yyyyMMdd"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("header", True).partitionBy("date").csv(path))


class KeyedTable:
    """A keyed aggregate table fed by streaming micro-batches.

    Plain files have no merge, so each micro-batch is written under
    ``date=<day>/generation=<g>/batch_id=<n>`` with dynamic partition
    overwrite: replaying a batch replaces exactly its own folders, which makes
    the sink idempotent. A generation belongs to one writer (one streaming
    checkpoint); a writer unseen so far gets the next one, because it counts
    its batches from 0 again. Generations are recorded, one row per writer, in
    ``_writers`` beside the data. Readers take the row of the highest
    (generation, batch) per key (update mode emits the whole current value of
    every changed group, so the latest batch is the answer). ``compact``
    rewrites a table to one row per key. One writer at a time.
    """

    VERSION = ["generation", "batch_id"]

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str],
                 partition_col: str = "date"):
        self.spark, self.path = spark, path
        self.keys, self.partition_col = list(keys), partition_col
        self._generations: dict[str, int] = {}

    def _writers(self) -> DataFrame:
        schema = "writer string, generation bigint"
        folder = f"{self.path}/_writers"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def generation(self, writer: str) -> int:
        """The writer's generation; the next free one is recorded for a new writer."""
        if writer not in self._generations:
            known = self._writers().agg(
                F.max(F.when(F.col("writer") == writer, F.col("generation"))).alias("own"),
                F.max("generation").alias("last")).first()
            g = known.own
            if g is None:
                g = 0 if known.last is None else known.last + 1
                (self.spark.createDataFrame([(writer, g)], "writer string, generation bigint")
                     .coalesce(1).write.mode("append").parquet(f"{self.path}/_writers"))
            self._generations[writer] = g
        return self._generations[writer]

    def _write(self, rows: DataFrame, path: str) -> None:
        # Few files a day; a large day is still split over several tasks.
        (rows.hint("rebalance", self.partition_col)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.partition_col, *self.VERSION).parquet(path))

    def upsert(self, batch: DataFrame, batch_id: int, writer: str | None = None) -> None:
        """Write one batch of ``writer`` (rows written by hand share one writer)."""
        g = self.generation(writer or "direct")
        self._write(batch.withColumn("generation", F.lit(g).cast("bigint"))
                         .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")), self.path)

    def raw(self) -> DataFrame:
        # Partition values come back type-inferred; the day key is text.
        df = self.spark.read.parquet(self.path)
        return df.withColumn(self.partition_col, F.col(self.partition_col).cast("string")) \
                 .withColumns({c: F.col(c).cast("bigint") for c in self.VERSION})

    def _latest(self, df: DataFrame) -> DataFrame:
        values = [c for c in df.columns if c not in self.keys + self.VERSION]
        return latest_by_key(df, self.keys, self.VERSION, values)

    def read(self, day: str | None = None) -> DataFrame:
        df = self.raw()
        if day is not None:
            df = df.filter(F.col(self.partition_col) == day)   # partition pruning
        return self._latest(df).drop(*self.VERSION)

    def compact(self, target: str) -> None:
        """Write the latest row per key to ``target`` (a new table folder).
        Rows keep their version and the writers their generations, so streams
        go on with the compacted table."""
        self._write(self._latest(self.raw()), target)
        self._writers().coalesce(1).write.mode("overwrite").parquet(f"{target}/_writers")
