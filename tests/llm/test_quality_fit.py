"""op7: the calibration always reaches its one minimum; scores are recomputed plainly."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
import zstandard
from conftest import SF_MID, SF_SMALL

from verdant.llm import quality as q


def plain_features(text, good, bad):
    """The four measures of a text, window by window."""
    data = text.encode()
    count = max(1, round(len(data) / q.WINDOW))
    step = math.ceil(len(data) / count)
    rows = []
    for piece in (data[i:i + step] for i in range(0, len(data), step)):
        sizes = [len(zstandard.ZstdCompressor(level=q.LEVEL, dict_data=zstandard.ZstdCompressionDict(d)).compress(piece))
                 for d in (good, bad)]
        difference = (sizes[1] - sizes[0]) / sum(sizes)
        dense = math.log(min(*sizes, len(piece)) / len(piece))
        rows.append((len(piece), difference, min(difference, 0), dense, dense * dense))
    return [sum(r[0] * r[k] for r in rows) / len(data) for k in range(1, 5)]


def minimum(x, y, w, ridge=q.RIDGE):
    """Slope of the penalised loss at intercept and weights ``w``."""
    scale = x.std(axis=0)
    used = scale > 1e-9 * np.maximum(np.abs(x.mean(axis=0)), 1e-3)
    p = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    slope = (x - x.mean(axis=0)).T @ (p - y) / len(y)
    return abs(float(np.mean(p - y))), np.abs(slope[used] / scale[used] + ridge / len(y) * (w[1:] * scale)[used]).max(initial=0)


@pytest.fixture(scope="module")
def measured(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = q.fit(docs, labels)
    rows = docs.join(labels, "doc_id").orderBy("doc_id").collect()
    pair = model.compressors()
    x = np.array([q.features(r.text, *pair) for r in rows if r.text])
    return x, np.array([float(r.quality) for r in rows if r.text])


@pytest.mark.parametrize("size", [20, 100, 300, 1000, 4000])
def test_resamples_reach_the_minimum(measured, size):
    x, y = measured
    rng = np.random.default_rng(size)
    for _ in range(120):
        at = rng.integers(0, len(y), size)
        if 0 < y[at].mean() < 1:
            w = q.logistic(x[at], y[at])
            off, slope = minimum(x[at], y[at], w)
            assert off < 1e-4 and slope < 1e-4
            kept = np.mean(w[0] + x[at] @ w[1:] >= 0)
            assert size < 100 or abs(kept - y[at].mean()) < 0.12      # the penalty weighs on 20 rows


def test_hard_designs(measured):
    x, y = measured
    rng = np.random.default_rng(1)
    apart = np.column_stack([2 * y - 1, rng.normal(size=len(y)) * 1e-6])         # separable, tiny scale
    twice = np.column_stack([x, x, np.ones(len(x))])                              # repeated and constant columns
    large = x * [1e6, 1e-6, 1, 1e3]
    rare = np.zeros(len(y))
    rare[0] = 1
    for design, mark in ((apart, y), (twice, y), (large, y), (x, rare), (x, 1 - rare), (np.zeros_like(x), y)):
        w = q.logistic(design, mark)
        off, slope = minimum(design, mark, w)
        assert off < 1e-4 and slope < 1e-4


def test_not_converging_is_an_error(measured):
    x, y = measured
    with pytest.raises(ArithmeticError, match="did not converge"):
        q.logistic(x, y, rounds=0)
    with pytest.raises(ArithmeticError):
        q.logistic(np.where(np.arange(x.size).reshape(x.shape) == 3, np.nan, x), y)


def test_scores_recomputed(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    model = q.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    got = {r.doc_id: r for r in q.score_quality(docs, model).collect()}
    rows = docs.orderBy("doc_id").limit(80).collect() + [r for r in docs.collect() if not r.text or len(r.text) > 20_000]
    for r in rows:
        if r.text:
            f = plain_features(r.text, model.good, model.bad)
            score = 1 / (1 + math.exp(-min(max(model.weights[0] + sum(a * b for a, b in zip(model.weights[1:], f, strict=True)), -30), 30)))
        else:
            score = model.blank
        assert math.isclose(got[r.doc_id].score, score, rel_tol=1e-9, abs_tol=1e-12)
        assert got[r.doc_id].predicted == int(score >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    held = q.op7_quality_classifier(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_stage_odd_rows(spark):
    """Empty tables, nulls, repeated rows and columns named like the operator's own."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert q.stage_quality(docs.limit(0), labels).count() == 0
    assert q.stage_quality(docs, labels.limit(0)).count() == docs.count()      # nothing is known, nothing goes
    odd = spark.createDataFrame([(None, None, 1.0), (1, "", 1.0), (1, "", 1.0), (2, None, 0.0)], "doc_id bigint, text string, score double")
    kept = q.stage_quality(odd, labels.limit(0))
    assert kept.count() == 4 and kept.columns == odd.columns
