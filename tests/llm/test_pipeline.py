"""The five stages, each held against its operator's rules on its own input."""

from __future__ import annotations

import collections

from conftest import SF_SMALL
from test_operators import brute_components, low

import corpus_pipeline
from verdant.llm.common import written


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, inputs = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        inputs.append(docs.collect())
        docs = written(stage(spark, docs, SF_SMALL), "stage")
        if stage is not corpus_pipeline.pack_windows:
            assert docs.columns == columns
    raw, good, exact, near, mixed = inputs
    assert len(good) <= len(raw)
    keep = collections.defaultdict(int)
    for r in good:
        keep[low(r.text)] = max(keep[low(r.text)], r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(keep.values())
    found = brute_components([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted({c for _, n, c in found})
    assert {r.doc_id for r in mixed} == {r.doc_id for r in near}
    pieces = docs.collect()
    totals = collections.Counter()
    for r in pieces:
        totals[r.doc_id] += r.length
    times = collections.Counter(r.doc_id for r in mixed)
    assert all(totals[r.doc_id] == r.doc_tokens * times[r.doc_id] for r in pieces)
