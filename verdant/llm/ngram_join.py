"""Near duplicates: an exact Jaccard join on word shingles.

Two sets of sizes s <= t reach 80 % only if 4 t <= 5 s and they share
ceil(4 t / 5) shingles or more, so they share one among the first
s - ceil(4 s / 5) + 1 shingles of each in any common order. The order puts
frequent shingles last, then goes by hash.

1. Equal shingle sets become one class.
2. Sets that share such a shingle meet in tiles: by shingle, by size band (a
   set only meets its own band and the next), and by blocks of at most
   ``BLOCK`` sets, so no tile grows with a hot shingle.
3. In a tile, hashed bitmaps bound the overlap from above: a bit that only
   one set has is a shingle that the other lacks. What passes is verified
   exactly on sorted arrays.
4. In every tile all sets are held against a few centres first; then tiles
   compare only sets that are not connected yet. A link between two sets of
   one component can't change it, so components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import ROW, batches_of, groups_of, result, rows_of, scratch, with_row_ids, written
from verdant.llm.components import components

WIDTH = 5              # words of a shingle
BITS_PER_SHINGLE = 2   # of a signature, at least; a power of two in all
HEAVY_COUNT = 16       # documents from which on a shingle moves to the end of the order
HEAVY_LIST = 100_000   # most frequent of those that move (800 kB); changes the order only
BLOCK = 512            # sets of a block; a tile has two blocks
SETTLED = 3            # sets of a tile up to which its centres meet all others
FEW = 24               # rows of a tile up to which plain integers beat arrays

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text. A-Z are
    lower-cased, words are runs without space, tab, LF, VT, FF and CR; a
    shorter text is one shingle; without words there is none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(WIDTH, len(words))
    out = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out ^= hashes[k:len(hashes) - width + 1 + k]
        out *= _MULTIPLY
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _key(own: np.ndarray) -> np.ndarray:
    """The upper 48 bits of shingle hashes: what sets meet by. Two shingles with
    one key only make more candidates; a set's order and keys agree."""
    return (own >> np.uint64(16)).view(np.int64)


def prefix(own: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The shingles of which a linked set has at least one in its own prefix."""
    count = len(own) - -(-4 * len(own) // 5) + 1
    if len(heavy):
        key = _key(own)
        late = heavy[np.minimum(np.searchsorted(heavy, key), len(heavy) - 1)] == key
        own = np.concatenate([own[~late], own[late]])
    return own[:count]


def _text_hash() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_hash")


def signature(own: np.ndarray) -> bytes:
    """A hashed bitmap as long as the set asks for. Sets of a band and the next
    differ at most by one doubling, and halves can be laid over each other."""
    width = max(64, 1 << (BITS_PER_SHINGLE * max(len(own), 1) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(own >> np.uint64(8)) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _keys(docs: DataFrame) -> DataFrame:
    """Every document's prefix by hash alone, one row per shingle."""
    none = np.empty(0, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [prefix(s, none) for t in batch.column("text").to_pylist() if len(s := shingles(t))]
            if parts:
                key, count = np.unique(_key(np.concatenate(parts)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key bigint, n bigint")


PAIR_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SET_SCHEMA = pa.schema([(ROW, pa.string()), ("text_hash", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int32()), ("digest", pa.binary()),
                        ("keys", pa.list_(pa.int64())), ("bits", pa.binary())])
SET_DDL = f"{ROW} string, text_hash binary, doc_id bigint, n int, digest binary, keys array<bigint>, bits binary"


def _sets(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row, text_hash, doc_id, text in rows_of(batches, ROW, "text_hash", "doc_id", "text"):
                own = shingles(text)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                yield row, text_hash, doc_id, len(own), digest, _key(prefix(own, heavy)) if len(own) else [], signature(own)

        yield from batches_of(rows(), SET_SCHEMA, 2048)

    return docs.select(ROW, _text_hash(), F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SET_DDL)


def _arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, own): sorted shingle arrays of the classes in ``wanted`` (set, text_hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("set", pa.int64()), ("own", pa.binary())])
        yield from batches_of(((s, shingles(t).tobytes()) for s, t in rows_of(batches, "set", "text")), schema, 512)

    # Short hashes first, so that what has to reach every text is small.
    short = written(wanted.select(F.xxhash64("text_hash").alias("short")).distinct(), "short-hashes")
    texts = docs.select("text", _text_hash()).join(short, F.xxhash64("text_hash") == F.col("short"), "left_semi") \
        .join(wanted, "text_hash")
    return texts.groupBy("set").agg(F.first("text").alias("text")).mapInArrow(run, "set bigint, own binary")


def _bitmap(signed: bytes) -> tuple[int, int]:
    return int.from_bytes(signed, "little"), 8 * len(signed)


def _folded(bits: int, width: int, to: int) -> int:
    while width > to:
        width //= 2
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


def _most(n: int, m: int, left: tuple[int, int], right: tuple[int, int]) -> int:
    """Upper bound of the overlap of two sets from their sizes and signatures."""
    width = min(left[1], right[1])
    a, b = _folded(*left, width), _folded(*right, width)
    return min(n - (a & ~b).bit_count(), m - (b & ~a).bit_count())


def _reaches(common: int, n: int, m: int) -> bool:
    return 100 * common >= 80 * (n + m - common)


def _overlap(left: bytes, right: bytes) -> tuple[int, int, int]:
    a, b = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
    return len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets reach the threshold: first by sizes
    and signatures, then exactly."""
    light = classes.select("set", "n", "bits")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for a, b, n, m, left, right in rows_of(batches, "a", "b", "n", "m", "left", "right"):
                if 4 * max(n, m) <= 5 * min(n, m) and _reaches(
                        _most(n, m, _bitmap(left), _bitmap(right)), n, m):
                    yield a, b

        yield from batches_of(rows(), PAIR_SCHEMA)

    near = pairs.join(light.select(F.col("set").alias("a"), "n", F.col("bits").alias("left")), "a") \
        .join(light.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("bits").alias("right")), "b")
    pairs = written(near.mapInArrow(bound, "a bigint, b bigint"), f"{label}-pairs")
    ends = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    wanted = written(classes.select("set", "text_hash").join(ends, "set"), f"{label}-wanted")
    arrays = written(_arrays(docs, wanted), f"{label}-arrays")
    both = pairs.join(arrays.select(F.col("set").alias("a"), F.col("own").alias("left")), "a") \
        .join(arrays.select(F.col("set").alias("b"), F.col("own").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for a, b, left, right in rows_of(batches, "a", "b", "left", "right"):
                common, s, t = _overlap(left, right)
                if _reaches(common, s, t):
                    yield a, b

        yield from batches_of(rows(), PAIR_SCHEMA)

    return written(both.mapInArrow(run, "a bigint, b bigint"), f"{label}-links")


def bounded_pairs(held: list[tuple], diagonal: bool) -> Iterator[tuple[int, int]]:
    """Pairs of a tile that sizes, places and signatures don't rule out and that
    are not connected yet. A row: (role, side, set, n, place, component, bits, earlier).
    In a diagonal tile all rows meet, else those of side 0 meet those of side 1;
    role 0 meets both roles. A pair counts where its first common shingle is, so
    no more than what follows that place can be common. A row ends with the
    shingles before the place."""
    if len(held) <= FEW:
        rows = [(*r[:6], _bitmap(r[6]), r[7]) for r in held]
        for i, (role, side, own, n, at, part, bits, earlier) in enumerate(rows):
            for role2, side2, other, m, at2, part2, bits2, earlier2 in rows[i + 1:]:
                if (part != part2 and not (role and role2) and (diagonal or side != side2) and 4 * max(n, m) <= 5 * min(n, m)
                        and 9 * min(n - at, m - at2) >= 4 * (n + m) and _reaches(_most(n, m, bits, bits2), n, m) and set(earlier).isdisjoint(earlier2)):
                    yield (own, other) if own < other else (other, own)
        return
    role = np.array([r[0] for r in held])
    side = np.array([r[1] for r in held])
    sets = np.array([r[2] for r in held])
    size = np.array([r[3] for r in held], dtype=np.int64)
    left = size - np.array([r[4] for r in held], dtype=np.int64)
    part = np.array([r[5] for r in held])
    width = min(len(r[6]) for r in held)
    bits = np.stack([np.bitwise_or.reduce(np.frombuffer(r[6], dtype=np.uint64).reshape(-1, width // 8), axis=0) for r in held])
    for i in range(len(held)):
        if diagonal:
            other = np.arange(i + 1, len(held))
        elif side[i] == 0:
            other = np.flatnonzero(side == 1)
        else:
            continue
        other = other[(part[other] != part[i]) & ((role[i] == 0) | (role[other] == 0))]
        small, large = np.minimum(size[other], size[i]), np.maximum(size[other], size[i])
        other = other[(4 * large <= 5 * small) & (9 * np.minimum(left[other], left[i]) >= 4 * (small + large))]
        if not len(other):
            continue
        only = np.bitwise_count(bits[i] & ~bits[other]).sum(axis=1, dtype=np.int64)
        rest = np.bitwise_count(bits[other] & ~bits[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(size[i] - only, size[other] - rest)
        other = other[100 * most >= 80 * (size[i] + size[other] - most)]
        before = set(held[i][7])
        for j in other.tolist():
            if before.isdisjoint(held[j][7]):
                yield (int(min(sets[i], sets[j])), int(max(sets[i], sets[j])))


def _roles(met: DataFrame) -> DataFrame:
    """A set in band b is in tile b (role 0) and in tile b - 1 (role 1)."""
    return met.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("role")).withColumn("tile", F.col("band") - F.col("role"))


def _star_pairs(met: DataFrame) -> DataFrame:
    """Every set of a tile with the tile's centres: its least and its largest set
    and that which meets most others, like the original of a group of near copies."""
    rows = _roles(met)
    centres = rows.groupBy("key", "tile").agg(
        F.min("set").alias("c0"), F.max("set").alias("c1"), F.max_by("set", "hub").alias("c2"),
        F.count("*").alias("sets"), F.min("role").alias("low")).filter("sets > 1 AND low = 0") \
        .select("key", "tile", F.explode(F.array_distinct(F.array("c0", "c1", "c2"))).alias("centre"))
    return rows.join(centres, ["key", "tile"]).filter("set <> centre") \
        .select(F.least("set", "centre").alias("a"), F.greatest("set", "centre").alias("b")).distinct()


def _tile_pairs(met: DataFrame, light: DataFrame, per_set: DataFrame) -> DataFrame:
    """Candidate pairs through tiles in which not all sets are connected yet and
    centres haven't met all others. ``light`` has set, component
    and bits, ``per_set`` the shingles that a set shares with any other."""
    rows = _roles(met.join(light.select("set", "component"), "set"))
    unsettled = rows.groupBy("key", "tile").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("role").alias("low"), F.count("*").alias("sets")) \
        .filter(f"lo <> hi AND low = 0 AND sets > {SETTLED}").select("key", "tile")
    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    rows = rows.join(unsettled, ["key", "tile"]).join(light.select("set", "bits"), "set") \
        .join(per_set.select("set", "shared"), "set").withColumn("earlier", F.transform(
            F.filter("shared", lambda x: x["place"] < F.col("place")), lambda x: x["key"])).drop("shared") \
        .withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("set", "key"), F.col("blocks")).cast("int")) \
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    rows = rows.select("key", "tile", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
                       "role", (F.col("own") > F.col("with")).cast("int").alias("side"), "set", "n", "place", "component", "bits",
                       "earlier")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple]:
            names = ("key", "tile", "i", "j", "role", "side", "set", "n", "place", "component", "bits", "earlier")
            for _, held in groups_of(rows_of(batches, *names), 4):
                if len(held) > 1:
                    yield from bounded_pairs([r[4:] for r in held], held[0][2] == held[0][3])

        yield from batches_of(pairs(), PAIR_SCHEMA)

    return rows.repartition("key", "tile", "i", "j").sortWithinPartitions("key", "tile", "i", "j") \
        .mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(ROW, doc_id, n_shingles, component_id, kept) of every row of ``docs``,
    which has ROW, doc_id and text.

    Rows link when 100 * common >= 80 * union over their distinct 5-word
    shingles. ``component_id`` is the smallest doc_id reachable by links, its
    own included; null ids count only where a component has no other. ``kept``
    marks one row per component, that with the smallest (doc_id, row). Null
    and empty texts and texts of blanks have no shingle and no link."""
    with scratch(docs.sparkSession):
        return result(_components(docs), "near-duplicates")


def _components(docs: DataFrame) -> DataFrame:
    counts = _keys(docs).groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY_COUNT)
    heavy = np.sort(np.array([r.key for r in counts.orderBy(F.desc("n"), "key").limit(HEAVY_LIST).collect()], dtype=np.int64))
    sets = written(_sets(docs, heavy), "sets")
    # Classes of equal sets; the row stands for the text, the numbers for the order of ids.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", F.col(ROW).alias("row"))).alias("first")
    per_class = sets.filter("n > 0").groupBy("digest").agg(
        first, F.min("text_hash").alias("text_hash"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    classes = written(per_class.withColumn("set", F.monotonically_increasing_id()), "classes")

    keyed = classes.select(F.posexplode("keys").alias("place", "key"), "set", "n") \
        .select("key", "set", (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("place")).alias("at"))
    repeated = keyed.groupBy("key").agg(F.count("*").alias("total")).filter("total > 1")
    met = written(keyed.join(repeated, "key").select(
        "key", "set", "total", F.shiftright("at", 32).cast("int").alias("n"), F.col("at").bitwiseAND(0xFFFFFFFF).cast("int").alias("place"))
        .withColumn("band", F.floor(F.log("n") / F.log(F.lit(1.25)) + F.lit(1e-9)).cast("int")), "met")
    per_set = written(met.groupBy("set").agg(F.sum("total").alias("hub"), F.collect_list(F.struct("place", "key")).alias("shared")),
                      "per-set")
    met = written(met.join(per_set.select("set", "hub"), "set"), "met-hubs")
    star = _star_pairs(met)
    links = _linked(star, docs, classes, "star")
    joined = written(components(links), "star-components")

    light = classes.select("set", "bits").join(joined.withColumnRenamed("node", "set"), "set", "left") \
        .withColumn("component", F.coalesce("component", "set"))
    links = links.unionByName(_linked(_tile_pairs(met, light, per_set), docs, classes, "tile"))
    final = components(links)

    grouped = classes.select("set", "digest", "first").join(final.withColumnRenamed("node", "set"), "set", "left") \
        .withColumn("component", F.coalesce("component", "set"))
    least = grouped.groupBy("component").agg(F.min("first").alias("least"))
    named = grouped.join(least, "component").select("digest", "least")
    out = sets.select(ROW, "doc_id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest")).join(named, "digest", "left")
    return out.select(ROW, "doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                      F.coalesce(F.col("least.row") == F.col(ROW), F.lit(True)).alias("kept"))


def op6_ngram_join(docs: DataFrame) -> DataFrame:
    """The query's rows over a ``documents`` table."""
    rows = docs.select("doc_id", "text").withColumn(ROW, F.monotonically_increasing_id().cast("string"))
    return near_duplicates(rows).select("doc_id", "n_shingles", "component_id")


def stage_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns kept."""
    rows = with_row_ids(docs, "near-docs")
    kept = near_duplicates(rows).filter("kept").select(F.col(ROW).alias("_kept_row"))
    return rows.join(kept, F.col(ROW) == F.col("_kept_row"), "left_semi").drop(ROW)
