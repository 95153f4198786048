"""op7: a text is judged by what it holds, not by its length, and learnt from as a whole."""

from __future__ import annotations

import random

from conftest import SF_MID
from pyspark.sql import functions as F

from verdant.llm import quality

CLEAN = ["the", "river", "runs", "to", "sea", "and", "hills", "under", "light", "of", "morning", "stone", "green", "far"]


def test_long_texts_score_like_their_parts(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    parts = docs.join(labels, "doc_id").filter(F.length("text").between(500, 8000)).orderBy("doc_id").collect()
    long = []
    for q in (1, 0):
        texts = [r.text for r in parts if r.quality == q]
        for k, size in enumerate((4_096, 65_536, 1_048_576)):
            at, joined = random.Random(k), ""
            while len(joined) < size:
                joined += at.choice(texts) + "\n"
            long.append((10_000_000 + 10 * q + k, joined))
    both = docs.unionByName(spark.createDataFrame(long, "doc_id bigint, text string"))
    got = {r.doc_id: r for r in quality.op7_quality_classifier(both, labels).filter("doc_id >= 10000000").collect()}
    assert {i - 10_000_000: r.predicted for i, r in got.items()} == {10: 1, 11: 1, 12: 1, 0: 0, 1: 0, 2: 0}
    assert abs(got[10_000_011].score - got[10_000_012].score) < 0.05


def test_parts_outside_a_slice_are_learnt(spark):
    def text(i, bad):
        at = random.Random(i)
        lines = [" ".join(at.choices(CLEAN, k=30)) for _ in range(140)]
        if bad:
            k = at.randrange(100)
            lines[k:k + 20] = ["BUY NOW CHEAP " * 11] * 20
        return "\n".join(lines)

    rows = [(i, text(i, i % 2), 1 - i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, quality int").repartition(8).cache()
    got = quality.op7_quality_classifier(table.drop("quality"), table.select("doc_id", "quality"))
    held = got.filter("held_out").join(table, "doc_id").select("score", "quality").collect()
    assert len(held) > 100 and sum(abs(r.score - r.quality) for r in held) < 0.05 * len(held)
