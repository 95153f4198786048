"""Runs of periodic repetition in word sequences, by tiles of a scale.

A run is a stretch of words with smallest period q (words q apart are
equal), at least ``max(MIN_LENGTH, 2 * q)`` long, that neither neighbour
extends. Periods are handled by octaves [P, 2P):

1. Every ``step(P)`` words lies a boundary. A run of a period q of the
   octave holds a boundary b with b + q still inside, so comparing the words
   from b and from b + q, forwards and backwards, finds it.
2. A document is exploded into overlapping tiles per octave: a core of
   ``CORE_STEPS`` boundaries at least, with 2P words (``BACK``) before it and
   4P words behind, so that every boundary sees enough on both sides. Tiles
   in which no boundary can succeed are not emitted: half of what a run needs
   at a boundary must be equal on one of its sides, which hashes of word
   windows rule out almost everywhere in prose (equal words have equal
   hashes, so no run is lost; unequal ones only cost time).
3. Tiles travel as rows of word numbers and are solved independently, each
   boundary by two Z-functions over its own surroundings: how far the words
   from b agree with those from b + q for all q at once, and how far back.
   Periods that a smaller one divides are dropped.
4. What a tile finds are fragments of runs, cut at its edges. They are
   shuffled by document and period; fragments of one run overlap by at least
   its period, those of different runs by less, so a window over each
   document and period stitches intervals back into runs.

Texts travel through a shuffle only where a tile was emitted; all others
are finished in the first pass. Everything is keyed by a row number, so
repeated and null ids do no harm, and a long text's tiles are solved by many
tasks.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, result, rows_of, scratch, written

MIN_LENGTH = 12         # words of the shortest run
CORE_STEPS = 16         # boundaries in the core of a tile, at least
CORE_WORDS = 512        # words in the core of a tile, at least
TASK_WORK = 1 << 20     # words between boundaries that a task solves
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


# ---------------------------------------------------------------------------
# Words
# ---------------------------------------------------------------------------
def words_of(doc_id: int | None, data: bytes | None, planted: bool = True) -> list[bytes]:
    """The words of a text. With ``planted``, every tenth document by the crc32
    of its id repeats itself from some word on (the query's made-up cases)."""
    words = (data or b"").split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if planted and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        unit = words[a:a + p]
        words[a:] = (unit * ((n - a) // p + 1))[:n - a]
    return words


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words, from 0 on."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int32)


# ---------------------------------------------------------------------------
# Tiles
# ---------------------------------------------------------------------------
def octaves(n: int) -> Iterator[int]:
    """Smallest periods of the octaves that a text of ``n`` words can repeat in."""
    p = 1
    while max(MIN_LENGTH, 2 * p) <= n:
        yield p
        p *= 2


def needed(period):
    """Equal words that a run of a period has at a boundary, counted on both sides."""
    return np.maximum(MIN_LENGTH - period, period)


def step(p: int) -> int:
    """Words between the boundaries of octave [p, 2p)."""
    return int(needed(np.arange(p, 2 * p)).min())


def reach(p: int) -> tuple[int, int]:
    """Words that a boundary sees before it and from it on."""
    return max(2 * p, MIN_LENGTH), max(4 * p, 2 * MIN_LENGTH)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _MIX[0] + b * _MIX[1]
    x ^= x >> np.uint64(31)
    return x * _MIX[2]


class _Windows:
    """Hashes of all windows of a length, built from those of powers of two."""

    def __init__(self, ids: np.ndarray):
        self.levels = {0: (ids.astype(np.uint64) + np.uint64(1)) * _MIX[2]}

    def of(self, length: int) -> np.ndarray:
        top = length.bit_length() - 1
        for k in range(max(self.levels), top):
            low = self.levels[k]
            self.levels[k + 1] = _joined(low[:-(1 << k)], low[1 << k:])
            self.levels.pop(k - 2, None)             # lengths grow but for the first few
        span, more = self.levels[top], length - (1 << top)
        return _joined(span[:-more], span[more:]) if more else span


def _equal_ahead(h: np.ndarray, p: int) -> np.ndarray:
    """For every ``p``-th place: is its hash found again ``p`` to ``2 p - 1`` places on?"""
    here = h[::p]
    ahead = np.zeros(len(here) * p, dtype=np.uint64)
    ahead[:max(0, len(h) - p)] = h[p:]
    return (ahead.reshape(-1, p) == here[:, None]).any(axis=1)


def candidates(ids: np.ndarray, p: int, windows: _Windows) -> np.ndarray:
    """Boundaries of octave ``p`` at which a run may lie (none is left out)."""
    apart = step(p)
    half = (apart + 1) // 2
    h = windows.of(half)
    found = np.zeros(-(-len(ids) // apart), dtype=bool)
    if apart == p:
        for first, part in ((0, h), (1, h[p - half:])):     # equal from a boundary on, or up to it
            hit = _equal_ahead(part, p)[:len(found) - first]
            found[first:first + len(hit)] |= hit
    else:
        for q in range(p, 2 * p):
            equal = h[:-q] == h[q:]
            for first, part in ((0, equal[::apart]), (1, equal[apart - half::apart])):
                part = part[:len(found) - first]
                found[first:first + len(part)] |= part
    return np.flatnonzero(found) * apart


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(octave, first word, word numbers, boundaries in them) of the tiles to solve."""
    n, windows = len(ids), _Windows(ids)
    for p in octaves(n):
        at = candidates(ids, p, windows)
        if not len(at):
            continue
        apart, (back, ahead) = step(p), reach(p)
        core = apart * max(CORE_STEPS, -(-CORE_WORDS // apart))
        for tile in np.unique(at // core).tolist():
            mine = at[at // core == tile]
            lo, hi = max(0, int(mine[0]) - back), min(n, int(mine[-1]) + ahead)
            yield p, lo, ids[lo:hi], mine - lo


# ---------------------------------------------------------------------------
# One tile
# ---------------------------------------------------------------------------
def z_function(s: list[int]) -> list[int]:
    """z[i]: how many symbols from i on equal those from the start."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    lo = hi = 0
    for i in range(1, n):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def at_boundary(s: list[int], b: int, p: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the fragments of octave ``p`` that boundary ``b``
    of tile ``s`` finds within its surroundings."""
    back, ahead = reach(p)
    lo, hi = max(0, b - back), min(len(s), b + ahead)
    far = min(2 * p, hi - b)                         # periods below this one
    if far <= p:
        return []
    forward = np.array(z_function(s[b:hi])[:far])
    left = s[lo:b][::-1]
    # Behind the separator lie the words before b + far, read backwards.
    z = z_function([*left, -1, *s[lo:b + far][::-1]])
    period = np.arange(far)
    backward = np.array(z)[len(left) + 1 + far - period] if left else np.zeros(far, dtype=np.int64)
    start, end = b - backward, b + period + forward
    square = np.flatnonzero((period > 0) & (forward + backward >= period))
    multiple = np.zeros(far, dtype=bool)             # a smaller period divides it
    for d in square.tolist():
        if not multiple[d]:
            over = square[(square > d) & (square % d == 0)]
            multiple[over[(start[d] <= start[over]) & (end[d] >= end[over])]] = True
    keep = square[(square >= p) & ~multiple[square]]
    keep = keep[(forward + backward)[keep] >= needed(keep)]
    return list(zip(keep.tolist(), start[keep].tolist(), end[keep].tolist(), strict=True))


def solve(p: int, ids: np.ndarray, boundaries: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, start, end) of a tile's fragments, stitched within the tile."""
    s, found = ids.tolist(), []
    for b in boundaries.tolist():
        found += at_boundary(s, b, p)
    out: list[tuple[int, int, int]] = []
    for q, start, end in sorted(found):
        if out and out[-1][0] == q and start <= out[-1][2] - q:
            out[-1] = (q, out[-1][1], max(end, out[-1][2]))
        else:
            out.append((q, start, end))
    return out


# ---------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------
SPLIT_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("text", pa.binary()),
                          ("collapsed_sha256", pa.string()), ("octave", pa.int64()), ("tile", pa.int64()),
                          ("ids", pa.binary()), ("boundaries", pa.binary())])
SPLIT_DDL = ("row bigint, doc_id bigint, n bigint, text binary, collapsed_sha256 string, octave bigint, tile bigint, "
             "ids binary, boundaries binary")
FRAGMENT_SCHEMA = pa.schema([("row", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
FRAGMENT_DDL = "row bigint, period bigint, start bigint, end bigint"
OUT_DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
           "runs_sha256 string, collapsed_sha256 string, kept binary")
OUT_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")),
                        ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("kept", pa.binary())])
NO_RUNS = hashlib.sha256(b"").hexdigest()


def exploded(docs: DataFrame, planted: bool, keep_texts: bool) -> DataFrame:
    """One row per document (``octave`` null) and one per tile, written. Unless
    ``keep_texts`` asks for all of them, a text stays only with a document that
    has tiles; the others are complete."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            row = TaskContext.get().partitionId() << 33
            for doc_id, data in rows_of(batches, "doc_id", "data"):
                words, some = words_of(doc_id, data, planted), keep_texts
                if len(words) >= MIN_LENGTH:
                    for p, lo, ids, at in tiles(numbered(words)):
                        some = True
                        yield row, None, None, None, None, p, lo, ids.tobytes(), at.astype(np.int32).tobytes()
                yield (row, doc_id, len(words), (data or b"") if some else None,
                       None if some else hashlib.sha256(b" ".join(words)).hexdigest(), None, None, None, None)
                row += 1

        yield from batches_of(rows(), SPLIT_SCHEMA, 512)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("data"))
    return written(rows.mapInArrow(split, SPLIT_DDL), "tiles")


def fragments(split: DataFrame) -> DataFrame:
    """(row, period, start, end) of what each tile holds. Tiles are dealt by
    document, octave and place, so a long text's tiles meet many tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for row, p, lo, ids, at in rows_of(batches, "row", "octave", "tile", "ids", "boundaries"):
                for q, start, end in solve(p, np.frombuffer(ids, dtype=np.int32), np.frombuffer(at, dtype=np.int32)):
                    yield row, q, lo + start, lo + end

        yield from batches_of(out(), FRAGMENT_SCHEMA)

    tiles = split.filter(F.col("octave").isNotNull()).select("row", "octave", "tile", "ids", "boundaries")
    # Tiles are few bytes and much work, so tasks are counted by work, not by size.
    work = tiles.agg(F.sum(F.col("octave") * (F.octet_length("boundaries") / 4))).first()[0] or 0
    return tiles.repartition(max(1, math.ceil(work / TASK_WORK)), "row", "octave", "tile").mapInArrow(run, FRAGMENT_DDL)


def stitched(found: DataFrame) -> DataFrame:
    """(row, start, period, length) of the runs: fragments of a document and
    period that overlap by the period or more are one run."""
    by = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before - F.col("period")), 1).otherwise(0)
    runs = found.withColumn("opens", opens).withColumn("run", F.sum("opens").over(by)) \
        .groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.select("row", "start", "period", (F.col("end") - F.col("start")).alias("length"))


def periodic_runs(docs: DataFrame, planted: bool = False, keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256, kept) of every row.

    ``start`` to ``exponent_milli`` describe the longest run (ties: smallest
    start, then period) and are null without a run. ``kept`` holds the words
    that stay, joined by one blank (null with ``keep_bytes=False``): a word goes
    if a run contains it after the run's first period. Null texts count as empty
    (no run, nothing kept); texts below ``MIN_LENGTH`` words have no run;
    repeated rows, null and repeated ids are kept as they are; an empty table
    gives an empty result. Only ``doc_id`` and ``text`` are read, so further
    columns may have any name."""
    with scratch(docs.sparkSession):
        split = exploded(docs, planted, keep_bytes)
        runs = stitched(fragments(split)).groupBy("row").agg(
            F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))

        def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                for doc_id, data, runs in rows_of(batches, "doc_id", "text", "runs"):
                    words = words_of(doc_id, data, planted)
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    for r in runs or ():
                        change[r["start"] + r["period"]] += 1
                        change[r["start"] + r["length"]] -= 1
                    keep = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    kept = b" ".join([words[i] for i in keep.tolist()])
                    lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs or ())
                    best = min(runs, key=lambda r: (-r["length"], r["start"], r["period"])) if runs else None
                    yield (doc_id, len(runs or ()),
                           *((best["start"], best["length"], best["period"], 1000 * best["length"] // best["period"])
                             if best else (None,) * 4),
                           hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                           kept if keep_bytes else None)

            yield from batches_of(out(), OUT_SCHEMA, 512)

        whole = split.filter(F.col("octave").isNull())
        some = whole.filter(F.col("text").isNotNull()).select("row", "doc_id", "text")
        done = some.join(runs, "row", "left").select("doc_id", "text", "runs").mapInArrow(collapse, OUT_DDL)
        nothing = [F.lit(None).cast("bigint").alias(c) for c in ("start", "length", "period", "exponent_milli")]
        rest = whole.filter(F.col("text").isNull()).select(
            "doc_id", F.lit(0).cast("bigint").alias("n_runs"), *nothing, F.lit(NO_RUNS).alias("runs_sha256"),
            "collapsed_sha256", F.lit(None).cast("binary").alias("kept"))
        return result(done.unionByName(rest), "runs")


def op11_periodic_runs(docs: DataFrame) -> DataFrame:
    """The query's rows over a ``documents`` table."""
    return periodic_runs(docs, planted=True, keep_bytes=False).drop("kept")
