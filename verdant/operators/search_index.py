"""Catalogue cleaning, postings and BM25 multi-field search as DataFrame jobs.

The reference sends each keyword to a search server (multi-field match over
title and volume, best field wins, top 30). Here a batch of queries is
scored against a postings table with joins and aggregates:

* postings: one row per (field, term, doc) with the term frequency, from
  ``lower`` + ``split`` on non-alphanumerics + ``explode`` over whole texts;
* field statistics (document count, average length) are one aggregate row
  per field, joined as a tiny table;
* scores: query terms join postings on (field, term); per (query, doc, field)
  the BM25 terms are summed, the best field wins, and a ``row_number`` filter
  keeps the top k per query (pre-limited per map partition by Spark).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.session import materialize

K1 = 1.2
B = 0.75
TOP_K = 30
BROADCAST_ROWS = 200_000   # query terms (about 100 bytes each) that every executor may hold
TASK_BYTES = 8 << 20       # text of a tokenising task, whose term counts take about 40 times as much
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text) -> Column:
    """Lower-cased alphanumeric tokens of a whole text. ``array_remove`` drops
    the empty pieces a leading or trailing delimiter leaves (no lambda, so it
    stays in generated code)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.array_remove(F.split(F.lower(t), TOKEN_SPLIT), ""),
                      F.array().cast("array<string>"))


def catalog_clean(raw: DataFrame, key: Sequence[str] = ("title", "volume")) -> DataFrame:
    """Trim text fields, drop rows without a title, keep one row per key
    (the smallest ``doc_id``); partial aggregation absorbs duplicated keys."""
    cleaned = raw.select("doc_id", F.trim("title").alias("title"), F.trim("volume").alias("volume"),
                         "price_unit").filter(F.length("title") > 0)
    first = F.min(F.struct("doc_id", "price_unit")).alias("_f")
    return cleaned.groupBy(*key).agg(first).select(
        F.col("_f.doc_id").alias("doc_id"), *key, F.col("_f.price_unit").alias("price_unit"))


def _dealt(docs: DataFrame, field: str, size: int) -> DataFrame:
    """(doc_id, field) dealt out by document, about ``TASK_BYTES`` of the
    ``size`` bytes of text to a task. The planner deals a table by a fixed
    number, so its tasks would grow with the table."""
    rows = docs.select("doc_id", field)
    tasks = math.ceil(size / TASK_BYTES)
    if tasks <= 1:
        return rows.repartition("doc_id")
    return rows.repartition(max(tasks, docs.sparkSession.sparkContext.defaultParallelism), "doc_id")


def postings(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, term, doc_id, tf) plus each document's field length ``dl``."""
    sizes = docs.agg(*[F.coalesce(F.sum(F.octet_length(f)), F.lit(0)).alias(f) for f in fields]).first()
    out = None
    for f in fields:
        toks = _dealt(docs, f, sizes[f]).select("doc_id", tokens(f).alias("toks"))
        # Dealt out by document before the regex split, which a table of few files
        # would run in as few tasks; the grouping then finds a document's rows
        # together, so texts are shuffled once and postings never.
        # explode_outer: plain explode would add an inferred size(toks) > 0
        # filter that evaluates the regex split a second time.
        p = toks.select("doc_id", F.size("toks").alias("dl"), F.explode_outer("toks").alias("term")) \
                .filter(F.col("term").isNotNull()) \
                .groupBy("doc_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf")) \
                .withColumn("field", F.lit(f))
        out = p if out is None else out.unionByName(p)
    return out


def field_stats(docs: DataFrame, post: DataFrame) -> dict[str, tuple[int, float]]:
    """Per field: (document count, average token length). One row per field
    comes back to the driver (bounded by the number of fields, not the
    data); the total length is the sum of term frequencies, so no second
    tokenizing pass is needed."""
    n_docs = docs.count()
    totals = {r["field"]: r["tokens"] for r in
              post.groupBy("field").agg(F.sum("tf").alias("tokens")).collect()}
    return {f: (n_docs, (totals.get(f) or 0) / n_docs if n_docs else 0.0) for f in totals}


def _per_field(stats: dict[str, tuple[int, float]], i: int) -> Column:
    expr = None
    for f, v in stats.items():
        expr = F.when(F.col("field") == f, F.lit(v[i])) if expr is None \
            else expr.when(F.col("field") == f, F.lit(v[i]))
    return expr if expr is not None else F.lit(None)


def document_frequency(post: DataFrame) -> DataFrame:
    return post.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def query_terms(queries: DataFrame, text: str = "query") -> DataFrame:
    """Distinct tokens of each query (a repeated query term counts once)."""
    q = queries.filter(F.length(F.trim(F.col(text))) > 0)   # F12: empty keyword rejected
    return q.select("query_id", F.explode(F.array_distinct(tokens(text))).alias("term"))


def _meet(weights: DataFrame, post: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Materialized query terms joined with the postings. The planner's estimate
    of exploded texts is that of the few bytes they are stored in, so it would
    broadcast the postings, which grow with the corpus. Counted query terms up
    to ``bound`` rows are broadcast, so postings stay where they are; beyond it
    both sides are sorted and merged, hot terms split. Same rows either way."""
    small = weights.count() <= bound
    return (F.broadcast(weights) if small else weights.hint("merge")).join(post, ["field", "term"])


def bm25_search(queries: DataFrame, docs: DataFrame, fields: Sequence[str],
                k: int = TOP_K, k1: float = K1, b: float = B,
                score_digits: int = 6) -> DataFrame:
    """T2 + O5: top ``k`` documents per query, best field wins, ties by doc id."""
    # The postings are the index: materialized once in the shared checkpoint
    # folder and read by the statistics, the document frequencies and the
    # scoring join, instead of re-tokenizing the corpus for each.
    post = materialize(postings(docs, fields))
    stats = field_stats(docs, post)
    dfreq = document_frequency(post)
    n_docs, avgdl = _per_field(stats, 0), _per_field(stats, 1)
    # Weights per (query, field, term) first; then one join with the postings.
    qt = query_terms(queries).join(dfreq, "term")
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = materialize(qt.select("query_id", "field", "term", idf.alias("idf"), avgdl.alias("avgdl")))
    hits = _meet(weights, post)
    norm = F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl"))
    term_score = F.col("idf") * F.col("tf") * (k1 + 1) / norm
    # Sum per field and best field in one aggregation: the fields are known
    # when the plan is built, so each gets a conditional sum.
    sums = [F.sum(F.when(F.col("field") == f, term_score)).alias(f"_s{i}")
            for i, f in enumerate(fields)]
    per_doc = hits.groupBy("query_id", "doc_id").agg(*sums)
    best_field = F.greatest(*[F.col(f"_s{i}") for i in range(len(fields))]) \
        if len(fields) > 1 else F.col("_s0")
    best = per_doc.select("query_id", "doc_id", F.round(best_field, score_digits).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    top = best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top
