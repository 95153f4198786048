"""Text search against a plain version, and its plans."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from conftest import SF_SMALL

from verdant.operators import search_index as si
from verdant.plans import QUERIES

DOCS = [(1, "Red tea, red cup", "small"), (2, "green tea", "tea tea"), (3, None, "cup"), (4, "", ""),
        (5, "tea " * 400 + "pot", None), (6, "green tea", "tea tea"), (7, "coffee pot", "large"), (8, "\u00c9clair tea", "1l")]
QUERIES_IN = [(1, "tea"), (2, "Tea cup TEA"), (3, "  "), (4, None), (5, "nothing here"), (6, "\u00e9clair pot")]
SCHEMA = "doc_id bigint, title string, volume string"


def _tokens(text):
    return [t for t in re.split(r"[^\w]+|_", (text or "").lower()) if t]


def _plain(docs, queries, k):
    fields = ("title", "volume")
    n = len(docs)
    toks = {f: {d[0]: _tokens(d[1 + i]) for d in docs} for i, f in enumerate(fields)}
    out = []
    for qid, text in queries:
        best = defaultdict(float)
        for f in fields:
            avg = sum(map(len, toks[f].values())) / n
            for term in set(_tokens(text)):
                df = sum(term in t for t in toks[f].values())
                for doc, t in toks[f].items():
                    tf = Counter(t)[term]
                    if tf:
                        part = math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (si.K1 + 1) \
                            / (tf + si.K1 * (1 - si.B + si.B * len(t) / avg))
                        best[doc, f] += part
        score = defaultdict(float)
        for (doc, _), s in best.items():
            score[doc] = max(score[doc], s)
        ranked = sorted(((-round(s, 6), d) for d, s in score.items()))[:k]
        out += [(qid, d, round(-s, 4), r) for r, (s, d) in enumerate(ranked, 1)]
    return sorted(out)


def _run(spark, docs, queries, k):
    top = si.bm25_search(spark.createDataFrame(queries, "query_id int, query string"),
                         spark.createDataFrame(docs, SCHEMA), ["title", "volume"], k=k)
    return sorted((r.query_id, r.doc_id, round(r.score, 4), r["rank"]) for r in top.collect())


def test_search_equals_a_plain_version(spark):
    for k in (1, 3, 30):
        assert _run(spark, DOCS, QUERIES_IN, k) == _plain(DOCS, QUERIES_IN, k)


def test_empty_tables(spark):
    assert _run(spark, [], QUERIES_IN, 3) == []
    assert _run(spark, DOCS, [], 3) == []


def test_merged_and_broadcast_query_terms_give_the_same_rows(spark):
    post = si.materialize(si.postings(spark.createDataFrame(DOCS, SCHEMA), ["title", "volume"]))
    terms = spark.createDataFrame([(1, "title", "tea"), (1, "volume", "tea"), (2, "title", "pot"), (None, "title", "cup")],
                                  "query_id int, field string, term string")
    small, large = si._meet(terms, post), si._meet(terms, post, bound=1)
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in (small, large)]
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
    cols = ["query_id", "field", "term", "doc_id", "tf", "dl"]
    rows = [sorted(map(str, d.select(*cols).collect())) for d in (small, large)]
    assert rows[0] == rows[1] and len(rows[0]) == 10


def test_postings_are_grouped_without_a_second_shuffle(spark):
    plan = QUERIES["postings"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan


def test_postings_are_never_broadcast(spark):
    plan = QUERIES["doc_search"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    build = plan[plan.index("BroadcastExchange"):]
    assert "BuildLeft" in plan and plan.count("BroadcastExchange") == 1 and "tf#" not in build.split("Scan ExistingRDD")[1]


def test_a_tokenising_task_holds_no_more_of_a_larger_table(spark, monkeypatch):
    monkeypatch.setattr(si, "TASK_BYTES", 1_000)
    parts = []
    for n in (200, 800):
        docs = spark.createDataFrame([(i, "red green tea pot " * 5) for i in range(n)], "doc_id bigint, text string")
        post = si.postings(docs, ["text"])
        assert post.count() == 4 * n and post._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        parts.append(post.rdd.getNumPartitions())
    assert parts == [18, 72]
    rows = [sorted(map(str, si.postings(spark.createDataFrame(DOCS, SCHEMA), ["title", "volume"]).collect()))]
    monkeypatch.undo()
    assert rows == [sorted(map(str, si.postings(spark.createDataFrame(DOCS, SCHEMA), ["title", "volume"]).collect()))]
