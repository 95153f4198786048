"""Exact dedup through a cuckoo-filter index of live digests.

Rows are dealt to shards by their digest. One shard has one ``CuckooIndex``:
a cuckoo filter (16-bit fingerprints, two candidate buckets of four slots)
in front of the bucketed content, i.e. the full digests with their group.
A filter miss proves that a digest is new; a hit is verified against the
content bucket. When an insertion finds no free slot after ``MAX_KICKS``
moves, the filter doubles and is refilled from the stored keys. Digests can
be deleted again, so a written index follows later insertions and takedowns.

Hot groups: equal digests are folded per Arrow batch before the shuffle, so
a text that makes up a third of all rows reaches its shard as one row per
batch. Shards hold about ``SHARD_ROWS`` rows whatever the input size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import ROW, batches_of, groups_of, rows_of, with_row_ids, written

SLOTS = 4            # entries of a filter bucket
FP_BITS = 16         # bits of a fingerprint
MAX_KICKS = 200      # moves before the filter doubles
SHARD_ROWS = 100_000  # rows per shard, on average

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rank(keep: int | None, row: int | None) -> tuple:
    """Null ids come first; of equal ids the larger row name comes last."""
    return keep is not None, keep or 0, row or ""


class CuckooIndex:
    """Digest -> [keep, keep_row, count], behind a cuckoo filter."""

    def __init__(self, buckets: int = 64):
        self.mask = buckets - 1
        self.size = 0
        self.resizes = 0
        self.table = [0] * (buckets * SLOTS)
        self.content: list[list[list]] = [[] for _ in range(buckets)]

    # Both buckets of a digest follow from its first bytes; the second one
    # follows from the first and the fingerprint, so entries can be moved.
    def _place(self, digest: bytes) -> tuple[int, int, int]:
        fp = (int.from_bytes(digest[8:10], "little") & ((1 << FP_BITS) - 1)) or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return fp, first, self._other(first, fp)

    def _other(self, bucket: int, fp: int) -> int:
        return bucket ^ ((fp * 0x5BD1E995) & self.mask)

    def _hit(self, fp: int, first: int, second: int) -> bool:
        t, a, b = self.table, first * SLOTS, second * SLOTS
        return fp in t[a:a + SLOTS] or fp in t[b:b + SLOTS]

    def find(self, digest: bytes) -> list | None:
        fp, first, second = self._place(digest)
        if not self._hit(fp, first, second):
            return None
        return next((e for e in self.content[first] if e[0] == digest), None)

    def _add(self, digest: bytes) -> bool:
        fp, first, second = self._place(digest)
        t = self.table
        for bucket in (first, second):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not t[s]:
                    t[s] = fp
                    return True
        bucket = second
        for kick in range(MAX_KICKS):
            s = bucket * SLOTS + (kick + fp) % SLOTS
            fp, t[s] = t[s], fp
            bucket = self._other(bucket, fp)
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not t[s]:
                    t[s] = fp
                    return True
        return False

    def _grow(self) -> None:
        entries = list(self.entries())
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.mask, self.resizes = buckets - 1, self.resizes + 1
            self.table = [0] * (buckets * SLOTS)
            if all(self._add(e[0]) for e in entries):
                break
        self.content = [[] for _ in range(buckets)]
        for e in entries:
            self.content[self._place(e[0])[1]].append(e)

    def insert(self, digest: bytes, keep, row, count: int) -> None:
        """Count ``digest`` once more; the group keeps the largest (id, row)."""
        found = self.find(digest)
        if found is None:
            entry = [digest, keep, row, count]
            self.content[self._place(digest)[1]].append(entry)
            self.size += 1
            if not self._add(digest):
                self._grow()
            return
        found[3] += count
        if _rank(keep, row) > _rank(found[1], found[2]):
            found[1], found[2] = keep, row

    def delete(self, digest: bytes) -> bool:
        """Forget a live digest; False if it isn't there."""
        found = self.find(digest)
        if found is None:
            return False
        fp, first, second = self._place(digest)
        for s in [*range(first * SLOTS, first * SLOTS + SLOTS), *range(second * SLOTS, second * SLOTS + SLOTS)]:
            if self.table[s] == fp:
                self.table[s] = 0
                break
        self.content[first].remove(found)
        self.size -= 1
        return True

    def entries(self) -> Iterator[list]:
        for bucket in self.content:
            yield from bucket


INDEX_SCHEMA = pa.schema([("shard", pa.int32()), ("digest", pa.binary()), ("keep_id", pa.int64()),
                          ("keep_row", pa.string()), ("group_size", pa.int64())])
INDEX_DDL = "shard int, digest binary, keep_id bigint, keep_row string, group_size bigint"


def normalised(text: Column) -> Column:
    """Null counts as empty; only A-Z are lower-cased."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def digests(rows: DataFrame) -> DataFrame:
    """(row, doc_id, digest) of every row, written once for both later passes."""
    return rows.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal digests of a batch become one row."""
    for batch in batches:
        best: dict[bytes, list] = {}
        for row, doc_id, digest in rows_of(iter([batch]), ROW, "doc_id", "digest"):
            held = best.get(digest)
            if held is None:
                best[digest] = [doc_id, row, 1]
                continue
            held[2] += 1
            if _rank(doc_id, row) > _rank(held[0], held[1]):
                held[0], held[1] = doc_id, row
        yield from batches_of(((0, d, *v) for d, v in best.items()), INDEX_SCHEMA)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One cuckoo index per shard; only one is in memory at a time."""
    def rows() -> Iterator[tuple]:
        shard, index = None, CuckooIndex()
        for at, digest, keep, row, count in rows_of(batches, *INDEX_SCHEMA.names):
            if at != shard:
                yield from ((shard, *e) for e in index.entries())
                shard, index = at, CuckooIndex()
            index.insert(digest, keep, row, count)
        yield from ((shard, *e) for e in index.entries())

    yield from batches_of(rows(), INDEX_SCHEMA)


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 21, 7)), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def build_index(light: DataFrame, shards: int) -> DataFrame:
    """(shard, digest, keep_id, keep_row, group_size) of rows from ``digests``."""
    folded = light.mapInArrow(_fold, INDEX_DDL).withColumn("shard", _shard(F.col("digest"), shards))
    return folded.repartition("shard").sortWithinPartitions("shard").mapInArrow(_index, INDEX_DDL)


def update_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame, shards: int) -> DataFrame:
    """A stored index after takedowns (``deleted``: digest) and then arrivals
    (``inserted``: rows from ``digests``). Every shard refills its filter from
    its stored keys, deletes, then inserts."""
    new = inserted.mapInArrow(_fold, INDEX_DDL).withColumn("shard", _shard(F.col("digest"), shards))
    gone = deleted.select(_shard(F.col("digest"), shards).alias("shard"), "digest",
                          F.lit(None).cast("bigint").alias("keep_id"), F.lit(None).cast("string").alias("keep_row"),
                          F.lit(0).cast("bigint").alias("group_size"))
    steps = (index.withColumn("step", F.lit(0)).unionByName(gone.withColumn("step", F.lit(1)))
             .unionByName(new.withColumn("step", F.lit(2))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            shard, live = None, CuckooIndex()
            for at, step, digest, keep, row, count in rows_of(
                    batches, "shard", "step", "digest", "keep_id", "keep_row", "group_size"):
                if at != shard:
                    yield from ((shard, *e) for e in live.entries())
                    shard, live = at, CuckooIndex()
                if step == 1:
                    live.delete(digest)
                else:
                    live.insert(digest, keep, row, count)
            yield from ((shard, *e) for e in live.entries())

        yield from batches_of(rows(), INDEX_SCHEMA)

    return steps.repartition("shard").sortWithinPartitions("shard", "step").mapInArrow(run, INDEX_DDL)


def exact_dedup(rows: DataFrame) -> DataFrame:
    """Group rows with equal normalised texts; the largest doc_id of a group stays.

    ``rows`` has ``ROW``, ``doc_id`` and ``text`` (other columns are not read).
    Returns ROW, doc_id, keep_id, keep_row, group_size, kept, text_sha256, one
    row per input row. Null texts equal empty ones. Null ids lose against any
    id. Of repeated rows (same id and text) exactly one is ``kept``, the one
    with the largest row name. An empty table gives an empty result.
    """
    light = written(digests(rows), "digests")
    shards = max(1, math.ceil(light.count() / SHARD_ROWS))
    index = written(build_index(light, shards), "cuckoo-index").drop("shard")
    return light.join(index, "digest").select(
        ROW, "doc_id", "keep_id", "keep_row", "group_size", (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op8_exact_dedup(docs: DataFrame) -> DataFrame:
    """The query's rows over a ``documents`` table."""
    rows = docs.select("doc_id", "text").withColumn(ROW, F.monotonically_increasing_id().cast("string"))
    return exact_dedup(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def stage_exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    rows = with_row_ids(docs, "exact-docs")
    kept = exact_dedup(rows).filter("kept").select(F.col(ROW).alias("_kept_row"))
    return rows.join(kept, F.col(ROW) == F.col("_kept_row"), "left_semi").drop(ROW)
