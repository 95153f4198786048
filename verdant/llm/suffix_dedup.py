"""Removal of repeated 400-byte strings by column-wise suffix sorting.

Which strings can be equal is found first, exactly. Every 400-byte string
has one anchor, its least 64-byte gram by hash (the leftmost of equals), so
equal strings have equal anchors at equal places. Consecutive strings with
one anchor form a segment; segments whose anchor occurs once are done.

Segments that share an anchor meet, aligned at it, in a collection of about
``CHUNK`` segments, which is sorted column by column from the right: a round
inserts one symbol in front of every segment's suffix. The new order is the
stable sort of the inserted symbols in the old order (the symbols, read in
that order, are the round's column of the collection's Burrows-Wheeler
transform), and the end of the prefix that a suffix shares with the one
before it is the least of the old ends between the two. Two suffixes that
share 400 bytes in a column are two occurrences of a repeated string.
Columns lie in a scratch file that is read once from end to end; it has no
name and goes with the task.

An anchor with more than ``CHUNK`` segments (a hot passage) would crowd a
task, so it is never dealt out by anchor: there are few such anchors, which
are broadcast. Its strings are compared through two 64-bit hashes each by
grouping, which Spark combines before the shuffle: those that occur once come
out with their place, and the other places hold repeated strings. Equal texts
are folded before all this: each of their strings is repeated.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, groups_of, rows_of, written

LENGTH = 400          # bytes of a repeated string
GRAM = 64             # bytes of an anchor
PIECE = 1 << 18       # string starts handled at a time, for long texts
CHUNK = 32_768        # segments of a collection
_POSITION = np.uint64((1 << 21) - 1)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _letters(seed: int) -> np.ndarray:
    """A random number for every byte value."""
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """Hashes of all substrings of ``length`` bytes, by doubling."""
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * _M[0] + b * _M[1]
        x ^= x >> np.uint64(31)
        x *= _M[2]
        x ^= x >> np.uint64(29)
        return x

    h, span = _letters(seed)[data], 1
    while 2 * span <= length:
        h, span = pair(h[:-span], h[span:]), 2 * span
    if span < length:
        shift = length - span
        h = pair(h[:-shift], h[shift:])
    return h


def segments(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, anchor, first start, last start) arrays of a text's strings."""
    width = length - gram + 1
    for at in range(0, len(data) - length + 1, PIECE):
        h = gram_hashes(data[at:at + PIECE + length - 1], gram)
        least, span = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * span <= width:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if span < width:
            least = np.minimum(least[:-(width - span)], least[width - span:])
        anchor = (least & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:] - 1, len(anchor) - 1]
        p = anchor[first]
        yield h[p].view(np.int64), p + at, first + at, last + at


def repeated_columns(held: list[tuple[int, bytes]], length: int, gram: int) -> np.ndarray:
    """For segments (anchor's place in it, bytes): which of their strings occur
    in another one. Row: segment; column c: the string that starts
    ``length - gram - c`` bytes before the anchor."""
    reach = length - gram
    m, wide = len(held), reach + length
    lo = np.array([reach - left for left, _ in held], dtype=np.int32)
    hi = lo + np.array([len(b) for _, b in held], dtype=np.int32)
    out = np.zeros((m, reach + 1), dtype=bool)
    with tempfile.TemporaryFile() as scratch:
        block = max(1, (1 << 24) // wide)
        file = np.memmap(scratch, dtype=np.uint8, mode="w+", shape=(wide, m))
        for at in range(0, m, block):
            part = np.zeros((min(block, m - at), wide), dtype=np.uint8)
            for k, (_, b) in enumerate(held[at:at + block]):
                part[k, lo[at + k]:hi[at + k]] = np.frombuffer(b, dtype=np.uint8)
            file[:, at:at + len(part)] = part.T
        order = np.arange(m)
        end = np.full(m, wide, dtype=np.int16)      # where the prefix shared with the one before ends
        levels = max(1, int(m).bit_length())
        table = np.empty((levels, m), dtype=np.int16)
        for c in range(wide - 1, -1, -1):
            symbol = np.asarray(file[c])[order].astype(np.int16)
            symbol[(lo[order] > c) | (hi[order] <= c)] = 256
            move = np.argsort(symbol, kind="stable")
            symbol = symbol[move]
            table[0] = end
            for k in range(1, levels):
                step = 1 << (k - 1)
                table[k, :m - step] = np.minimum(table[k - 1, :m - step], table[k - 1, step:])
                table[k, m - step:] = table[k - 1, m - step:]
            same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] < 256)) + 1
            new = np.full(m, c, dtype=np.int16)
            a, b = move[same - 1] + 1, move[same]
            level = np.frexp(b - a + 1)[1] - 1
            new[same] = np.minimum(table[level, a], table[level, b - (1 << level) + 1])
            order, end = order[move], new
            if c <= reach:
                hit = np.flatnonzero(end - c >= length)
                out[order[hit], c] = True
                out[order[hit - 1], c] = True
        del file
    return out


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last index of every run of True."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    yield from zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True)


ANCHOR_SCHEMA = pa.schema([("uid", pa.int64()), ("anchor", pa.int64()), ("p", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64())])
SEGMENT_SCHEMA = pa.schema([("anchor", pa.int64()), ("hot", pa.bool_()), ("uid", pa.int64()), ("p", pa.int64()),
                            ("s0", pa.int64()), ("s1", pa.int64()), ("own", pa.binary())])
RUN_SCHEMA = pa.schema([("uid", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
RUN_DDL = "uid bigint, a bigint, b bigint"


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def shared_segments(anchors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``anchors`` (a written table) whose anchor occurs twice or
    more, with ``hot``: more than ``chunk`` times. Rows of hot anchors stay
    where they are, at most one anchor per ``chunk`` rows is broadcast."""
    shared = written(anchors.groupBy("anchor").agg(F.count("*").alias("total")).filter("total > 1"), "shared")
    crowded = F.broadcast(shared.filter(F.col("total") > chunk).select("anchor"))
    rest = anchors.join(crowded, "anchor", "left_anti").join(
        shared.filter(F.col("total") <= chunk).select("anchor"), "anchor").withColumn("hot", F.lit(False))
    return rest.unionByName(anchors.join(crowded, "anchor").withColumn("hot", F.lit(True)))


def hot_runs(crowded: DataFrame, strings: DataFrame) -> DataFrame:
    """(uid, a, b): runs of starts in ``crowded`` (uid, s0, s1) but for those
    of ``strings`` (uid, a, h1, h2) that occur once. The places of one string,
    however many, are never brought together; those of one text are."""
    single = strings.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("uid").alias("uid"), F.min("a").alias("a")).filter("n = 1")
    spans = crowded.groupBy("uid").agg(F.collect_list(F.struct("s0", "s1")).alias("spans")).join(
        single.groupBy("uid").agg(F.collect_list("a").alias("once")), "uid", "left")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for uid, spans, once in rows_of(batches, "uid", "spans", "once"):
                once = np.sort(np.array(once or (), dtype=np.int64))
                for s in spans:
                    flags = np.ones(s["s1"] - s["s0"] + 1, dtype=bool)
                    flags[once[slice(*np.searchsorted(once, (s["s0"], s["s1"] + 1)))] - s["s0"]] = False
                    yield from ((uid, s["s0"] + a, s["s0"] + b) for a, b in _runs(flags))

        yield from batches_of(rows(), RUN_SCHEMA)

    return spans.mapInArrow(runs, RUN_DDL)


def repeated_runs(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """(uid, a, b): runs of starts of repeated strings in ``texts`` (uid, text),
    a written table of distinct texts with distinct uids."""
    reach = length - gram

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, text in rows_of(batches, "uid", "text"):
            data = np.frombuffer(_bytes(text), dtype=np.uint8)
            for found in segments(data, length, gram):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), uid)), *map(pa.array, found)], schema=ANCHOR_SCHEMA)

    long = texts.filter(F.octet_length("text") >= length)
    anchors = written(long.select("uid", "text").mapInArrow(
        find, "uid bigint, anchor bigint, p bigint, s0 bigint, s1 bigint"), "anchors")
    wanted = shared_segments(anchors, chunk).groupBy("uid").agg(
        F.collect_list(F.struct("anchor", "hot", "p", "s0", "s1")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for uid, text, wanted in rows_of(batches, "uid", "text", "wanted"):
                data = _bytes(text)
                for w in wanted:
                    yield w["anchor"], w["hot"], uid, w["p"], w["s0"], w["s1"], data[w["s0"]:w["s1"] + length]

        yield from batches_of(rows(), SEGMENT_SCHEMA, 4096)

    met = written(long.select("uid", "text").join(wanted, "uid").mapInArrow(
        cut, "anchor bigint, hot boolean, uid bigint, p bigint, s0 bigint, s1 bigint, own binary"), "segments")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(held: list[tuple]) -> Iterator[tuple]:
            flags = repeated_columns([(p - s0, own) for _, _, p, s0, own in held], length, gram)
            for row in np.flatnonzero(flags.any(axis=1)).tolist():
                _, uid, p, _, _ = held[row]
                yield from ((uid, p - reach + a, p - reach + b) for a, b in _runs(flags[row]))

        def rows() -> Iterator[tuple]:
            held: list[tuple] = []
            for _, group in groups_of(rows_of(batches, "anchor", "uid", "p", "s0", "own"), 1):
                if len(group) > 1:
                    held += group
                if len(held) >= chunk:
                    yield from solved(held)
                    held = []
            if held:
                yield from solved(held)

        yield from batches_of(rows(), RUN_SCHEMA)

    plain = met.filter("not hot").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, RUN_DDL)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, s0, own in rows_of(batches, "uid", "s0", "own"):
            data = np.frombuffer(own, dtype=np.uint8)
            h = [gram_hashes(data, length, seed).view(np.int64) for seed in (1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h[0]), uid)), pa.array(np.arange(len(h[0])) + s0), *map(pa.array, h)],
                                             names=["uid", "a", "h1", "h2"])

    strings = met.filter("hot").mapInArrow(hashed, "uid bigint, a bigint, h1 bigint, h2 bigint")
    return plain.unionByName(hot_runs(met.filter("hot").select("uid", "s0", "s1"), strings))


def removed_spans(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte spans [start, end) covered by strings that start in ``runs``."""
    spans: list[list[int]] = []
    for a, b in sorted(runs):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b + length)
        else:
            spans.append([a, b + length])
    return [(a, b) for a, b in spans]


RESULT_DDL = "uid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
RESULT_SCHEMA = pa.schema([("uid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                           ("kept_sha256", pa.string()), ("kept", pa.binary())])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK, keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, n_kept) of every row.

    A byte goes if a ``length``-byte string that covers it starts anywhere
    else too, in the same or another text. Null texts count as empty; texts
    shorter than ``length`` stay whole; longer texts that occur in two rows
    or more go whole. Repeated rows, null and repeated ids are kept as they
    are. ``kept`` holds the remaining bytes (null with ``keep_bytes=False``),
    ``n_kept`` counts them."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    texts = rows.select(digest, "text").groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = written(texts.withColumn("uid", F.monotonically_increasing_id()), "texts")
    runs = repeated_runs(texts.select("uid", "text"), length, gram, chunk)
    per_text = written(runs.groupBy("uid").agg(F.collect_list(F.struct("a", "b")).alias("runs")), "runs")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for uid, text, copies, runs in rows_of(batches, "uid", "text", "copies", "runs"):
                data, at, left = _bytes(text), 0, []
                spans = [(0, len(data))] if copies > 1 and len(data) >= length else removed_spans(
                    [(r["a"], r["b"]) for r in runs or ()], length)
                for a, b in spans:
                    left.append(data[at:a])
                    at = b
                kept = b"".join([*left, data[at:]])
                yield (uid, len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None)

        yield from batches_of(out(), RESULT_SCHEMA, 1024)

    done = texts.select("uid", "text", "copies").join(per_text, "uid", "left").mapInArrow(apply, RESULT_DDL)
    named = texts.select("uid", "digest").join(done, "uid").drop("uid")
    light = rows.select("doc_id", digest, F.octet_length("text").cast("bigint").alias("n_bytes"))
    return light.join(named, "digest").drop("digest").withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))


def op4_suffix_dedup(docs: DataFrame) -> DataFrame:
    """The query's rows over a ``documents`` table."""
    return suffix_dedup(docs, keep_bytes=False).drop("kept")
