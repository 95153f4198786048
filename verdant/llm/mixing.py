"""Mixing sources to target weights by temperature.

A source's weight is its token share raised to an exponent, normalised. An
exponent of 1 leaves the natural shares, 0 makes all sources equal. The
flattest mix is wanted that stays within a target entropy (a share of the
largest possible) and a repetition limit; both grow as the exponent falls,
so the exponent is bisected, four bits per pass over the source table.

The weights are realised as block permutations: every pass over a source is
a permutation of its documents by hash, whole passes first, then the part
of a last one that the source's token budget still covers. Running token
sums go by (source, pass, hash range), ranges hold about ``RANGE_ROWS`` rows
and only range totals are summed along a source, so a source with a third
of all rows is no single task. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import ROW, with_row_ids, written

TARGET_ENTROPY = 0.98   # of the entropy of equal weights
MAX_PASSES = 2.0        # times that a document may be repeated
EXPONENT_BITS = 24      # precision of the exponent
RANGE_ROWS = 4_096      # rows of a hash range, on average
SLACK = 1e-9            # for comparing computed entropies and passes
WORD = "[^ \\t\\r\\n]+"   # a token, for budgets


def token_count(text: Column) -> Column:
    """Blank-separated words; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_tokens(rows: DataFrame) -> DataFrame:
    """(source, tokens, n) of rows with source and tokens."""
    return rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))


def _passes(tokens: Column, most: float, z: float, exponent: Column, budget: int | None) -> Column:
    """Passes over a source. Without a budget the largest source gets one and
    every other one more; else the budget is split by weight."""
    if budget is None:
        return F.pow(F.lit(most) / tokens, F.lit(1.0) - exponent)
    return F.lit(float(budget)) * F.pow(tokens / F.lit(most), exponent) / F.lit(z) / tokens


def fit_exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_passes: float = MAX_PASSES,
                 budget: int | None = None) -> tuple[float, float, float]:
    """(exponent, largest source's tokens, sum of relative weights).

    The exponent is the smallest in [0, 1], in steps of 2^-24, that keeps
    entropy and passes within bounds; 1 if none does. Sources without tokens
    don't count. One row per tried exponent reaches the driver."""
    live = sources.filter("tokens > 0").select(F.col("tokens").cast("double").alias("tokens"))
    size = live.agg(F.max("tokens").alias("most"), F.count("*").alias("n")).first()
    if not size.n:
        return 1.0, 1.0, 1.0
    most, equal, unit = size.most, math.log(size.n), 1 << EXPONENT_BITS
    x = F.pow(F.col("tokens") / F.lit(most), F.col("e"))

    def measure(grid: list[int]) -> dict[int, tuple[bool, float]]:
        tried = live.select("tokens", F.explode(F.array(*[F.lit(g) for g in grid])).alias("g")) \
            .withColumn("e", F.col("g") / F.lit(float(unit)))
        rows = tried.groupBy("g").agg(
            F.sum(x).alias("z"), F.sum(x * F.log(x)).alias("s"),
            F.max(F.pow(F.lit(most) / F.col("tokens"), F.lit(1.0) - F.col("e"))).alias("cover"),
            F.max(x / F.col("tokens")).alias("per")).collect()
        return {r.g: (math.log(r.z) - r.s / r.z <= target_entropy * equal + SLACK
                      and (r.cover if budget is None else budget * r.per / r.z) <= max_passes + SLACK, r.z) for r in rows}

    bad, good = -1, unit
    while good - bad > 1:
        grid = sorted({bad + (good - bad) * k // 16 for k in range(1, 16)} - {bad, good})
        seen = measure(grid)
        good = min((g for g in grid if seen[g][0]), default=good)
        bad = max((g for g in grid if g < good), default=bad)
    return good / unit, most, measure([good])[good][1]


def weights(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_passes: float = MAX_PASSES,
            budget: int | None = None) -> DataFrame:
    """(source, tokens, n, weight, budget, whole, part) per source: token budget,
    whole passes and the tokens of a last, partial one. A source without
    tokens gets one whole pass."""
    exponent, most, z = fit_exponent(sources, target_entropy, max_passes, budget)
    tokens = F.col("tokens").cast("double")
    passes = _passes(tokens, most, z, F.lit(exponent), budget)
    out = sources.withColumn("weight", F.when(F.col("tokens") > 0, F.pow(tokens / F.lit(most), F.lit(exponent)) / F.lit(z))
                             .otherwise(F.lit(0.0)))
    out = out.withColumn("budget", F.when(F.col("tokens") > 0, F.floor(tokens * passes + F.lit(SLACK))).otherwise(F.lit(0)))
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / tokens)).otherwise(F.lit(1)).cast("int")
    out = out.withColumn("whole", whole)
    return out.withColumn("part", F.col("budget") - F.col("whole") * F.col("tokens"))


def _offsets(totals: DataFrame, head: int) -> DataFrame:
    """(source, pass, range, base): the tokens before each range of a pass.

    Summed in two levels, over ranges that share their first ``head`` digits and
    over those heads, so no window holds all ranges of a source."""
    level = ["source", "pass", "head"]
    totals = totals.withColumn("head", F.substring("range", 1, head))
    across = Window.partitionBy("source", "pass").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*level).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.groupBy(*level).agg(F.sum("held").alias("held")).select(
        *level, F.coalesce(F.sum("held").over(across), F.lit(0)).alias("before"))
    return totals.withColumn("own", F.coalesce(F.sum("held").over(inside), F.lit(0))).join(heads, level) \
        .select("source", "pass", "range", (F.col("before") + F.col("own")).alias("base"))


def mix(rows: DataFrame, target_entropy: float = TARGET_ENTROPY, max_passes: float = MAX_PASSES,
        budget: int | None = None) -> DataFrame:
    """(ROW, doc_id, source, tokens, pass, start): the passes in which a row
    appears and the tokens before it in its source's pass.

    ``rows`` has ROW, doc_id, source and tokens; a null source counts as the
    empty name. Order in a pass: md5 of pass and doc_id, then doc_id, tokens
    and row, so repeated rows and ties have a fixed place. Rows without tokens
    come with every whole pass, and with a partial one if it reaches them.
    Without a budget every row appears at least once."""
    rows = rows.withColumn("source", F.coalesce("source", F.lit("")))
    sources = written(source_tokens(rows), "sources")
    plan = weights(sources, target_entropy, max_passes, budget)
    ranges = max(1, math.ceil((sources.agg(F.sum("n").alias("n")).first().n or 0) / RANGE_ROWS))
    digits = max(1, math.ceil(math.log(ranges, 16)))
    last = F.col("whole") - F.when(F.col("part") > 0, F.lit(0)).otherwise(F.lit(1))
    passed = rows.join(plan.select("source", "whole", "part"), "source").filter(last >= 0).select(
        "*", F.explode(F.sequence(F.lit(0), last)).alias("pass"))
    key = F.md5(F.concat(F.col("pass").cast("string"), F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                .cast("binary"))
    passed = passed.withColumn("key", key).withColumn("range", F.substring("key", 1, digits))
    offsets = _offsets(passed.groupBy("source", "pass", "range").agg(F.sum("tokens").alias("held")), max(1, digits // 2))
    inside = Window.partitionBy("source", "pass", "range").orderBy("key", "doc_id", "tokens", ROW) \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = passed.join(offsets, ["source", "pass", "range"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return placed.filter((F.col("pass") < F.col("whole")) | (F.col("start") + F.col("tokens") <= F.col("part"))) \
        .select(ROW, "doc_id", "source", "tokens", "pass", "start")


def measured(docs: DataFrame) -> DataFrame:
    """The light columns that ``mix`` needs."""
    return docs.select(ROW, F.col("doc_id").cast("bigint").alias("doc_id"), "source", token_count(F.col("text")).alias("tokens"))


def op10_mix_sources(docs: DataFrame) -> DataFrame:
    """The query's rows: every appearance of every document of a ``documents`` table."""
    rows = written(measured(docs.select("doc_id", "source", "text").withColumn(ROW, F.monotonically_increasing_id().cast("string"))), "mix-rows")
    return mix(rows).drop(ROW)


def stage_mix(docs: DataFrame) -> DataFrame:
    """``docs`` with every row once per appearance, all columns kept. Rows without
    tokens (null and empty texts) appear, rows that repeat are placed one by one,
    a null source is a source of its own; an empty table stays empty. No column
    may carry the name of ``ROW``."""
    rows = with_row_ids(docs, "mix-docs")
    light = written(measured(rows), "mix-rows")
    picks = mix(light).select(F.col(ROW).alias("_picked_row"))
    return rows.join(picks, F.col(ROW) == F.col("_picked_row")).drop(ROW, "_picked_row")


ORACLE = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\r\n]+'))::BIGINT AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM r GROUP BY source),
live AS (SELECT tokens::DOUBLE AS t, (SELECT max(tokens) FROM s)::DOUBLE AS most FROM s WHERE tokens > 0),
bisect(step, bad, good) AS (
  SELECT 0, -1::BIGINT, 16777216::BIGINT
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN bad ELSE mid END, CASE WHEN ok THEN mid ELSE good END
  FROM (SELECT b.step, b.bad, b.good, b.mid,
          (SELECT ln(sum(x)) - sum(x * ln(x)) / sum(x) <= 0.98 * ln(count(*)) + 1e-9 AND max(p) <= 2.0 + 1e-9
           FROM (SELECT pow(t / most, b.mid / 16777216.0::DOUBLE) AS x,
                        pow(most / t, 1.0 - b.mid / 16777216.0::DOUBLE) AS p FROM live) q) AS ok
        FROM (SELECT *, (bad + good) // 2 AS mid FROM bisect WHERE good - bad > 1) b) c),
e AS (SELECT min(good) / 16777216.0::DOUBLE AS e FROM bisect),
b AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN
        floor(tokens * pow((SELECT max(tokens) FROM s)::DOUBLE / tokens, 1.0 - (SELECT e FROM e)) + 1e-9)::BIGINT ELSE 0 END AS budget FROM s),
plan AS (SELECT source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS whole,
         CASE WHEN tokens > 0 THEN budget - (budget // tokens) * tokens ELSE 0 END AS part FROM b),
passed AS (
  SELECT r.*, plan.whole, plan.part, u.pass FROM r JOIN plan USING (source),
    LATERAL (SELECT unnest(range(0, plan.whole + CASE WHEN plan.part > 0 THEN 1 ELSE 0 END)) AS pass) u),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, pass
    ORDER BY md5(pass::VARCHAR || '/' || coalesce(doc_id::VARCHAR, '')), doc_id, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM passed)
SELECT doc_id, source, tokens, pass::INTEGER AS pass, start FROM placed
WHERE pass < whole OR start + tokens <= part
"""
