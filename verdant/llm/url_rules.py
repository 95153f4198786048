"""URL rules by a sort-merge range join.

The key of a host is its labels in reverse, each followed by a dot, so a
host and all its subdomains have keys in one interval: ``example.net`` is
``net.example.``, up to but without ``net.example/``. URLs are cut into
ranges of keys, and every rule goes to the ranges its interval touches. In
a range, rules and URLs are read in key order; a stack holds the rules whose
interval is open, nested rules above those around them. A URL is held
against the paths of the rules on the stack.

Range bounds come from a random sample of the rows, as pairs of key and row
hash, so a host with a third of all rows is spread over many ranges; they
decide where a row is judged, never how. There are as many ranges as the
cluster has use for, not as the rows: a sweep streams its range, so ranges
may be of any length, and the sample and the bounds don't grow with the input.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, rows_of, written

RANGE_ROWS = 200_000   # URLs of a range, at least on average
RANGES_PER_CORE = 4    # ranges at most, for each core or shuffle partition
SAMPLE_PER_RANGE = 20  # sampled rows behind a bound
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), "."), F.lit("."))


ROW_NAMES = ("range", "key", "kind", "path", "verdict", "page_id", "host")
OUT_SCHEMA = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string())])


def sweep(rows: Iterator[tuple], default: str) -> Iterator[tuple]:
    """Judge sorted rows (``ROW_NAMES``); kind 0 is a rule, 1 a URL."""
    at, stack = None, []
    for part, key, kind, path, verdict, page_id, host in rows:
        if part != at:
            at, stack = part, []
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if kind == 0:
            if not stack or stack[-1][0] != key:
                stack.append((key, {}))
            paths = stack[-1][1]
            if paths.get(path, ("", ""))[1] != "block":
                paths[path] = (host + path, verdict)
            continue
        best, length = (None, default), -1
        for own, paths in reversed(stack):
            if len(own) + len(path) <= length:
                break
            for size in sorted({len(p) for p in paths}, reverse=True):
                if len(own) + size > length and size <= len(path) and (hit := paths.get(path[:size])):
                    best, length = hit, len(own) + size
                    break
        yield page_id, host, path, *best


def most_ranges(spark: SparkSession) -> int:
    """What the cluster has use for: some ranges per core or shuffle partition."""
    return RANGES_PER_CORE * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` has host (lower case), path and verdict (allow or block). A rule
    fits its host and all subdomains if the url's path starts with its own.
    The longest host and path together win, at equal length the longer host;
    of equal rules block wins. Without a rule the verdict is ``default``.
    Null urls and those without ``://`` have an empty host and path and fit
    no rule. Repeated rows and null ids are judged as they are; an empty table
    gives an empty result; rules with a null or empty host don't count."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = written(urls.withColumn("key", host_key(F.col("host")))
                   .withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "urls")
    ranges = min(urls.count() // RANGE_ROWS + 1, most_ranges(pages.sparkSession))
    sample = urls.select("key", "salt").orderBy("salt").limit(ranges * SAMPLE_PER_RANGE).collect() if ranges > 1 else []
    sample = sorted((r.key, r.salt) for r in sample)
    bounds = sorted({sample[k * len(sample) // ranges] for k in range(1, ranges)}) if sample else []
    names = ["range", "key", "kind", "path", "verdict", "page_id", "host"]
    ddl = "range int, key string, kind int, path string, verdict string, page_id bigint, host string"
    schema = pa.schema([("range", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), ("path", pa.string()),
                        ("verdict", pa.string()), ("page_id", pa.int64()), ("host", pa.string())])

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(((bisect_right(bounds, (key, salt)), key, 1, path, None, page_id, host) for key, salt, path, page_id, host
                               in rows_of(batches, "key", "salt", "path", "page_id", "host")), schema)

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for key, host, path, verdict in rows_of(batches, "key", "host", "path", "verdict"):
                # The interval's ends: its key, and the same with the last dot's successor.
                for at in range(bisect_left(bounds, (key,)), bisect_left(bounds, (key[:-1] + "/",)) + 1):
                    yield at, key, 0, path, verdict, None, host

        yield from batches_of(rows(), schema)

    told = rules.filter("host <> ''").select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
    both = urls.mapInArrow(place_urls, ddl).unionByName(
        told.withColumn("key", host_key(F.col("host"))).mapInArrow(place_rules, ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(sweep(rows_of(batches, *names), default), OUT_SCHEMA)

    return both.repartition("range").sortWithinPartitions("range", "key", "kind") \
        .mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string")


# The query's rules; fixed values.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op2_url_rules(pages: DataFrame) -> DataFrame:
    """The query's rows over a ``pages`` table."""
    rules = pages.sparkSession.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge_urls(pages, rules)


ORACLE = r"""
WITH a AS (SELECT page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS at_ FROM pages),
b AS (SELECT page_id, CASE WHEN at_ > 0 THEN substr(u, at_ + 3) ELSE '' END AS rest FROM a),
c AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM b),
d AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM c),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
e AS (SELECT d.*, (SELECT arg_max([h || p, v], length(h || p)) FROM rules
                   WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS hit FROM d)
SELECT page_id, host, path, hit[1] AS rule, coalesce(hit[2], 'allow') AS verdict FROM e
"""
