"""Exact top-k inner products through vector-approximation files.

Vectors become integers, floor(256 x) per component, and are dealt to blocks
of about ``BLOCK``. A block's approximation file holds a four-bit cell per
component with the least and largest value in each cell. For a query, the
cells alone bound every score from above; exact vectors are then read in the
order of their bounds until the k-th score can't be beaten any more. Blocks
answer on their own and the k best of all blocks win, so a task holds one
block and a batch of queries, whatever the number of either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import ROW, batches_of, rows_of, written

SCALE = 256        # a component x becomes floor(SCALE * x)
CELLS = 16         # cells of a component: four bits
BLOCK = 8_192      # vectors of a block, on average
FIRST = 64         # exact vectors read at first; doubles until the result is certain
EXACT = float(1 << 53)


class ApproximationFile:
    """Cells of one block of integer vectors (float64 arrays of whole numbers)."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.lexsort((rows, ids))
        self.vectors, self.ids, self.rows = vectors[order], ids[order], rows[order]
        low, high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        width = np.maximum((high - low) / CELLS, 1e-300)
        self.cells = np.minimum((self.vectors - low) / width, CELLS - 1).astype(np.uint8)
        dims = vectors.shape[1]
        # The values that really occur in a cell bound it tighter than its edges.
        self.least = np.full((CELLS, dims), np.inf)
        self.most = np.full((CELLS, dims), -np.inf)
        column = np.broadcast_to(np.arange(dims), self.cells.shape)
        np.minimum.at(self.least, (self.cells, column), self.vectors)
        np.maximum.at(self.most, (self.cells, column), self.vectors)
        self.peak = float(np.abs(self.vectors).max(initial=0.0))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, queries x vectors, from cells alone."""
        column = np.arange(self.cells.shape[1])
        return (np.maximum(queries, 0) @ self.most[self.cells, column].T
                + np.minimum(queries, 0) @ self.least[self.cells, column].T)

    def scores(self, query: np.ndarray, at: np.ndarray) -> list[int]:
        """Exact scores: floats while sums stay below 2^53, else Python integers."""
        part = self.vectors[at]
        if self.peak * float(np.abs(query).max(initial=0.0)) * len(query) < EXACT:
            return [int(x) for x in part @ query]
        whole = [int(x) for x in query]
        return [sum(a * int(b) for a, b in zip(whole, v.tolist(), strict=True)) for v in part]

    def best(self, query: np.ndarray, row: int, bound: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, position), without the query's own row."""
        n = len(bound)
        # Large sums carry rounding; widen the bounds by more than that.
        slack = 0.0 if self.peak * float(np.abs(query).max(initial=0.0)) * len(query) < EXACT else 1e-9
        bound = bound + slack * (np.abs(bound) + 1)
        read = min(n, max(FIRST, 2 * k))
        while True:
            at = np.argpartition(-bound, read - 1)[:read] if read < n else np.arange(n)
            found = sorted(((-s, p) for s, p in zip(self.scores(query, at), at.tolist(), strict=True) if self.rows[p] != row))[:k]
            if read == n:
                return found
            rest = np.partition(-bound, read)[read]
            if len(found) == k and -rest < -found[-1][0]:
                return found
            read = min(n, 2 * read)


def vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    """(ROW, vec_id, parts) of the rows that take part, as whole numbers: not
    null, without null or non-finite components, with an id. Shorter vectors
    count as padded with zeros; an empty vector scores 0 with every other."""
    parts = F.col(column).cast("array<double>")
    fine = F.col(column).isNotNull() & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.withColumn(ROW, F.monotonically_increasing_id()).filter(fine & F.col("vec_id").isNotNull()).select(
        ROW, F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(parts, _floor).alias("parts"))


def _floor(x):
    """floor(SCALE * x) as a double; Spark's floor would leave a bigint and overflow."""
    scaled = x * F.lit(float(SCALE))
    return F.when(F.abs(scaled) < F.lit(EXACT), F.floor(scaled).cast("double")).otherwise(scaled)


def top_k(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query.

    ``rows`` and ``queries`` come from ``vectors``, written, queries being rows
    too. A query's own row is no candidate; rows that repeat its id are. Ties
    go to the smaller vec_id. Fewer than k candidates give fewer rows, scores
    beyond 64 bits are held at the largest number. Without rows or queries the
    result is empty; columns but ``ROW``, vec_id and parts aren't read."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("parts")).alias("dims")).first()
    blocks, dims = max(1, -(-size.n // block)), max(1, size.dims or 0)
    held = rows.withColumn("block", F.pmod(F.xxhash64(ROW), F.lit(blocks)).cast("int")).withColumn("kind", F.lit(0))
    asked = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1))
    both = held.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((batch.num_rows, dims))
        parts = batch.column("parts")
        values, lengths = parts.flatten().to_numpy(zero_copy_only=False), parts.value_lengths().to_numpy(zero_copy_only=False)
        out[np.arange(dims) < lengths[:, None]] = values
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            at, gathered, file = None, [], None
            for batch in batches:
                block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
                edges = np.r_[0, np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1, len(block)]
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    part = batch.slice(a, b - a)
                    if block[a] != at:
                        at, gathered, file = block[a], [], None
                    own = (matrix(part), part.column("vec_id").to_numpy(), part.column(ROW).to_numpy())
                    if kind[a] == 0:
                        gathered.append(own)
                        continue
                    if file is None:
                        if not gathered:
                            continue
                        file = ApproximationFile(*(np.concatenate(x) for x in zip(*gathered, strict=True)))
                        gathered = []
                    for low in range(0, b - a, 256):
                        q = own[0][low:low + 256]
                        for query, vec_id, row, bound in zip(q, own[1][low:], own[2][low:], file.bounds(q), strict=False):
                            for minus, p in file.best(query, row, bound, k):
                                yield int(row), int(vec_id), int(file.ids[p]), max(min(-minus, 2**63 - 1), -2**63)

        yield from batches_of(rows(), schema)

    near = both.mapInArrow(run, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    rank = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op9_top_k(embeddings: DataFrame) -> DataFrame:
    """The query's rows: every 50th vector against all."""
    rows = written(vectors(embeddings), "vectors")
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


ORACLE = """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM ok q JOIN ok c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""
