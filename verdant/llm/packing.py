"""Packing documents into token windows by Karmarkar-Karp differencing.

Documents are tokenised, an end id is added, and full windows are cut off;
each is a sequence of its own without padding. What remains of a document
is shorter than a window. Those remainders are dealt at random to groups of
about ``GROUP_PIECES``; within a group multiway differencing repeatedly
merges the two partial partitions with the largest imbalance, heaviest
windows against lightest, which leaves near-equal windows. One remainder in
``CHIP_EVERY`` is cut into chips first, so that differencing has small parts
to even out the large ones. The number of windows starts at the least that can
hold the group and rises while any window is over capacity; nothing else
places a part.

Everything is keyed by a piece number, not by doc_id, so repeated or null
ids, hot sources and copies can't crowd a group.
"""

from __future__ import annotations

import heapq
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, groups_of, rows_of, written

WINDOW = 2_048          # ids of a sequence
END_ID = 1              # added to every document
GROUP_PIECES = 512      # remainders per group, on average
CHIP_EVERY = 16         # of so many remainders one is cut into chips
CHIP = 24               # ids of a chip
CACHE_WORDS = 800_000   # pre-tokens whose ids a worker remembers; only saves time
PAD_ID = 0

PIECE_DDL = ("piece bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary")
PIECE_SCHEMA = pa.schema([("piece", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                          ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])


# Character classes of the vocabulary's pre-tokenizer below U+0100; fixed values.
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = "\t\n\x0b\x0c\r \x85\xa0"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+").findall


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves, the others as letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary's merges never cross a pre-token, so the ids of frequent
    pre-tokens are looked up. Texts with characters beyond U+00FF, or with
    the string of a special token, go through the tokenizer as a whole."""

    _open: dict[str, WordTokenizer] = {}

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        """One per worker process, so later tasks find its pre-tokens known."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def ids(self, text: str | None) -> bytes:
        text = text or ""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._whole(text)
        if "<|" in text:
            return self._whole(text)
        words = WORDS(text.lower())
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            new = {w for w in words if w not in known}
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = set(words)
            for w in new:
                spelt = w.encode().decode("latin-1").translate(self.letters)
                known[w] = np.array([t.id for t in self.merge(spelt)], dtype="<u4").tobytes()
            return b"".join([known[w] for w in words])

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Tokenise whole texts and cut them: full windows and one remainder. The
    table is written, so every later step sees the same piece numbers. Null
    texts count as empty and give one piece, the end id; rows that repeat and
    null ids are cut as they are; an empty table gives an empty result. Only
    doc_id and text are read, whatever other columns there are."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(tokenizer_path)

        def rows() -> Iterator[tuple]:
            piece = TaskContext.get().partitionId() << 33
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                ids = tokenizer.ids(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start:4 * (start + window)]
                    yield piece, doc_id, start, len(part) // 4, zlib.crc32(part), total, part
                    piece += 1

        yield from batches_of(rows(), PIECE_SCHEMA, 1024)

    return written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, PIECE_DDL), "pieces")


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item by Karmarkar-Karp multiway differencing.

    A partial partition is a vector of window loads in ascending order, less
    its minimum. The two with the largest spread are merged in opposite
    order; how slots were matched is noted and unrolled at the end."""
    n = len(sizes)
    if windows == 1:
        return np.zeros(n, dtype=np.int64)
    loads: dict[int, np.ndarray] = {}
    made: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)

    def vector(node: int) -> np.ndarray:
        if node >= n:
            return loads.pop(node)
        v = np.zeros(windows, dtype=np.int64)
        v[-1] = sizes[node]
        return v

    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = vector(a) + vector(b)[::-1]
        order = np.argsort(total, kind="stable")
        total = total[order]
        total -= total[0]
        node = n + len(made)
        loads[node] = total
        made.append((a, b, order.astype(np.int32)))
        heapq.heappush(heap, (-int(total[-1]), node))
    # Unroll: slot j of a merged node is slot order[j] of a and windows-1-order[j] of b.
    window = np.zeros(n, dtype=np.int64)
    place: dict[int, np.ndarray] = {n + len(made) - 1: np.arange(windows)} if made else {}
    if not made:
        return window
    for k in range(len(made) - 1, -1, -1):
        a, b, order = made[k]
        at = place.pop(n + k)
        slots = np.empty(windows, dtype=np.int64)
        slots[order] = at
        for child, own in ((a, slots), (b, slots[::-1])):
            if child < n:
                window[child] = own[-1]
            else:
                place[child] = own
    return window


def chips(sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, start, length) of the parts that are dealt: items as they are, but
    every ``CHIP_EVERY``-th, and one at least, in chips of ``CHIP`` ids.
    Differencing places large parts first, and chips even out what they leave."""
    n = len(sizes)
    cut = set(range(CHIP_EVERY - 1, n, CHIP_EVERY)) or ({int(sizes.argmax())} if n else set())
    return [(i, at, min(CHIP if i in cut else size, size - at))
            for i, size in enumerate(sizes.tolist()) for at in range(0, size, CHIP if i in cut else size)]


def fill(sizes: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of near-equal load within capacity: lists of (item, start, length).

    The number of windows starts at the least that can hold the items and rises
    as long as one is over capacity, by what the imbalance asks for. An item is
    never over capacity, so it ends with a window for every item. Parts of an
    item that meet in a window again are joined."""
    parts = chips(sizes)
    lengths, total = np.array([p[2] for p in parts], dtype=np.int64), int(sizes.sum())
    count = max(1, math.ceil(total / capacity))
    while True:
        if count >= len(sizes):
            return [[(i, 0, size)] for i, size in enumerate(sizes.tolist())]
        window = differencing(lengths, count)
        load = np.bincount(window, weights=lengths, minlength=count)
        if load.max() <= capacity:
            break
        over = load.max() - total / count
        # A quarter of the way to where even this imbalance would fit.
        far = math.ceil(total / (capacity - over)) if over < capacity else len(sizes)
        count += max(1, (far - count) // 4)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    for (item, start, length), w in zip(parts, window.tolist(), strict=True):
        if out[w] and out[w][-1][0] == item and out[w][-1][1] + out[w][-1][2] == start:
            out[w][-1] = (item, out[w][-1][1], out[w][-1][2] + length)
        else:
            out[w].append((item, start, length))
    return out


OUT_SCHEMA = pa.schema([*list(PIECE_SCHEMA)[1:6], ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
OUT_DDL = PIECE_DDL.removeprefix("piece bigint, ").removesuffix(", ids binary") + ", sequence_id bigint, offset bigint, ids binary"


def pack(cut: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES, keep_ids: bool = True) -> DataFrame:
    """Give every piece of ``pieces`` its sequence and offset; some are cut once more.

    A sequence takes the number of a piece, so ids are unique without counting.
    Repeated rows and null ids are pieces of their own; null texts count as empty. ``keep_ids=False`` leaves ``ids`` null.
    An empty table gives an empty result; an empty text is one piece with the
    end id alone."""
    full = cut.filter(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("piece") * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"), (F.col("ids") if keep_ids else F.lit(None).cast("binary")).alias("ids"))
    rest = cut.filter(F.col("length") < window)
    groups = max(1, math.ceil(rest.count() / group_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, held in groups_of(rows_of(batches, "_group", "piece", "doc_id", "start", "doc_tokens", "length", "ids"), 1):
                # No more windows than remainders, so each takes the number of one.
                for (_, number, *_), items in zip(held, fill(np.array([r[5] for r in held], dtype=np.int64), window)):
                    sequence, offset = 2 * number, 0
                    for i, start, length in items:
                        _, _, doc_id, first, total, _, ids = held[i]
                        part = ids[4 * start:4 * (start + length)]
                        yield (doc_id, first + start, length, zlib.crc32(part), total, sequence, offset,
                               part if keep_ids else None)
                        offset += length

        yield from batches_of(rows(), OUT_SCHEMA, 1024)

    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("piece"), F.lit(groups)).cast("int"))
    packed = dealt.repartition("_group").sortWithinPartitions("_group", "piece").mapInArrow(run, OUT_DDL)
    return full.unionByName(packed)


def sequences(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(sequence_id, n_ids, input_ids array<int>) with padding, except where
    the number of ids is a power of two."""
    whole = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sequence_id", pa.int64()), ("n_ids", pa.int32()), ("input_ids", pa.list_(pa.int32()))])

        def rows() -> Iterator[tuple]:
            for sequence, parts in rows_of(batches, "sequence_id", "parts"):
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), dtype="<u4").astype(np.int32)
                short = 0 if len(ids) & (len(ids) - 1) == 0 else window - len(ids)
                yield sequence, len(ids), np.pad(ids, (0, short), constant_values=PAD_ID)

        yield from batches_of(rows(), schema, 256)

    return whole.mapInArrow(build, "sequence_id bigint, n_ids int, input_ids array<int>")


def op3_packing(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The query's rows: every piece of every document with its place."""
    return pack(pieces(docs, tokenizer_path), keep_ids=False).drop("ids")
