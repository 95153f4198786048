"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.session import checkpoint_dir

#: Row name given by ``with_row_ids``; no input column may carry this name.
ROW = "_verdant_row"


_scopes: list[list[str]] = []


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder that the cluster names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, but for those of ``result``."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _write(df: DataFrame, label: str, owners: list[list[str]]) -> DataFrame:
    path = work_dir(df.sparkSession, label)
    if owners:
        owners[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage, survives lost executors, and keeps column pruning."""
    return _write(df, label, _scopes)


def result(df: DataFrame, label: str) -> DataFrame:
    """As ``written``, for what outlives the innermost ``scratch``."""
    return _write(df, label, _scopes[:-1])


def with_row_ids(df: DataFrame, label: str) -> DataFrame:
    """``df`` with a unique, stable row name. Row decisions are joined back by
    it, so repeated or null ids do no harm. Rows of files are named by file and
    place, whatever way the files are split; other frames are written first."""
    try:
        return df.withColumn(ROW, F.concat(F.hex(F.xxhash64(F.col("_metadata.file_path"))), F.lit(":"),
                                           F.col("_metadata.row_index").cast("string")))
    except AnalysisException:
        return written(df.withColumn(ROW, F.monotonically_increasing_id().cast("string")), label)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Python rows of a stream of Arrow batches."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def groups_of(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that agree in their first ``width`` fields (rows are sorted by them)."""
    key, held = None, []
    for row in rows:
        if row[:width] != key:
            if held:
                yield key, held
            key, held = row[:width], []
        held.append(row)
    if held:
        yield key, held


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
