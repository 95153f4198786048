"""Quality score by compression with two zstandard dictionaries.

One dictionary is built from documents labelled good, one from documents
labelled bad. A text is cut into windows, each window is compressed with
both, and the normalised difference of the two sizes says which kind of
text it resembles. Logistic regression on labelled documents that are in
neither dictionary turns the differences into a calibrated score.

The model is fitted on a bounded sample of the labelled rows: at most
``DICT_DOCS`` documents of a class for its dictionary, each with at most
``SAMPLE_CHARS`` characters in ``SAMPLE_PIECES`` pieces from its beginning to
its end, and ``FIT_DOCS`` for the calibration. Calibration and scoring alike read every byte of a
text, and what they measure is a mean over its windows, so that a text isn't
judged by its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICT_DOCS = 2_000       # labelled documents of a class behind its dictionary
FIT_DOCS = 4_000        # labelled documents behind the calibration
SAMPLE_CHARS = 4_096    # characters a document gives to a dictionary
SAMPLE_PIECES = 16      # evenly spaced pieces that they come in, if the document is longer
RIDGE = 1.0             # penalty of the calibration's standardised weights
FEATURES = ("difference", "below", "density", "square")
DICT_BYTES = 112_640    # size of a dictionary
WINDOW = 1_024          # bytes compressed at a time
LEVEL = 3


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries and logistic weights; small and fixed in size, so it travels in the closure."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]      # intercept, then one weight per feature
    blank: float                    # score of a text without bytes

    def compressors(self) -> tuple:
        return tuple(zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d)).compress
                     for d in (self.good, self.bad))


def features(text: str, good, bad) -> tuple[float, float, float, float]:
    """Means over a text's windows: (difference, its part below 0, logarithm of
    the smaller size against the length, that squared). The text isn't empty.

    A difference is (bad size - good size) / (bad size + good size). The third
    value tells repetition, which both dictionaries compress alike. A mean is
    the same for a text and for the text many times over, unlike a minimum."""
    data = text.encode("utf-8", "surrogatepass")
    count = max(1, round(len(data) / WINDOW))
    step = math.ceil(len(data) / count)
    total = below = density = square = 0.0
    for at in range(0, len(data), step):
        piece = data[at:at + step]
        g, b = len(good(piece)), len(bad(piece))
        difference, dense = (b - g) / (b + g), math.log(min(g, b, len(piece)) / len(piece))
        share = len(piece) / len(data)
        total += share * difference
        below += share * min(difference, 0.0)
        density += share * dense
        square += share * dense ** 2
    return total, below, density, square


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 100) -> np.ndarray:
    """Intercept and weights of ridge-penalised logistic regression.

    Columns are standardised, so the penalty means the same for each, and a
    constant column gets no weight. The loss is strictly convex in the rest and
    each Newton step is halved until the loss falls enough, so the rounds can
    only go down to the one minimum. The intercept isn't penalised: at the
    minimum the mean score equals the share of label 1, which is checked.
    ``ArithmeticError`` if the minimum isn't reached."""
    n, mean, scale = len(y), x.mean(axis=0), x.std(axis=0)
    used = np.flatnonzero(scale > 1e-9 * np.maximum(np.abs(mean), 1e-3))
    z = np.column_stack([np.ones(n), (x[:, used] - mean[used]) / scale[used]])
    penalty = np.full(z.shape[1], ridge / n)
    penalty[0] = 0.0
    w = np.zeros(z.shape[1])
    w[0] = math.log(y.mean() / (1 - y.mean()))

    def loss(w: np.ndarray) -> float:
        a = z @ w
        return float(np.mean(np.logaddexp(0, a) - y * a) + penalty @ w ** 2 / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (p - y) / n + penalty * w
        if np.abs(slope).max() < 1e-8:
            break
        bend = z.T @ (z * (p * (1 - p))[:, None]) / n + np.diag(penalty)
        bend[0, 0] += 1e-12
        step, size = np.linalg.solve(bend, slope), 1.0
        while (new := loss(w - size * step)) > now - 1e-4 * size * float(slope @ step) and size > 1e-12:
            size /= 2
        w, now = w - size * step, min(now, new)
    p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
    slope = z.T @ (p - y) / n + penalty * w
    if not np.isfinite(x).all() or not np.isfinite(w).all() or np.abs(slope).max() > 1e-5 or abs(p.mean() - y.mean()) > 1e-4:
        raise ArithmeticError(f"the calibration did not converge: slope {np.abs(slope).max():.2g}, "
                              f"mean score {p.mean():.4f}, share of label 1 {y.mean():.4f}, {n} rows")
    weights = np.zeros(x.shape[1])
    weights[used] = w[1:] / scale[used]
    return np.concatenate([[w[0] - weights @ mean], weights])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def fit(docs: DataFrame, labels: DataFrame) -> CompressionModel:
    """Fit on labelled rows outside the held-out fold (``fold`` = 1).

    Repeated labels of a document count by their maximum; null labels don't
    count. The score of the empty text is the share of label 1 in the sample
    (0.5 without any label). If a class is missing, its dictionary is that of a
    fixed blank text and every text gets that score. A calibration that doesn't
    converge is an error."""
    marks = (labels.select("doc_id", "quality").dropna().groupBy("doc_id")
             .agg(F.max("quality").alias("_quality")))
    marks = marks.filter(fold(F.col("doc_id")) != 1).withColumn("_at", F.xxhash64(F.col("doc_id"), F.lit(7)))
    in_dictionary = F.pmod(F.col("_at"), F.lit(2)) == 0
    chosen = [marks.filter(in_dictionary & (F.col("_quality") == k)).orderBy("_at", "doc_id").limit(DICT_DOCS) for k in (1, 0)]
    # At most 2 * DICT_DOCS and FIT_DOCS ids, so texts stay where they are.
    texts = docs.select("doc_id", "text").filter(F.length("text") > 0)
    # Evenly spaced pieces of a long text, so that every part of it is seen.
    size = SAMPLE_CHARS // SAMPLE_PIECES
    spread = F.concat_ws("", *[F.substring("text", F.floor(F.length("text") * k / SAMPLE_PIECES).cast("int") + 1, F.lit(size))
                               for k in range(SAMPLE_PIECES)])
    piece = F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(spread)
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id") \
        .select("_at", "_quality", piece.alias("piece")).groupBy("_at", "_quality").agg(F.min("piece").alias("piece")).collect()
    rows.sort(key=lambda r: (r["_at"], r.piece))
    parts = {k: [r.piece.encode() for r in rows if r["_quality"] == k] for k in (1, 0)}
    dictionary = {k: _dictionary(v) for k, v in parts.items()}
    model = CompressionModel(dictionary[1], dictionary[0], (), 0.5)
    sample = _measured(texts.join(F.broadcast(marks.filter(~in_dictionary).orderBy("_at", "doc_id").limit(FIT_DOCS)), "doc_id"), model)
    y = np.array([float(r["_quality"] == 1) for r in sample])
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    if not len(y) or not parts[0] or not parts[1] or y.min() == y.max():
        return CompressionModel(model.good, model.bad, (math.log(share / (1 - share)), *[0.0] * len(FEATURES)), share)
    weights = logistic(np.array([tuple(r.f) for r in sample]), y)
    return CompressionModel(model.good, model.bad, tuple(weights.tolist()), share)


def _measured(rows: DataFrame, model: CompressionModel) -> list:
    """(_at, _quality, f) of the labelled rows: the features of whole texts, taken in tasks."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors()
        for batch in batches:
            f = np.array([features(t, *pair) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("_at"), batch.column("_quality"), *map(pa.array, f.T.copy())],
                                             names=["_at", "_quality", *FEATURES])

    schema = "_at bigint, _quality bigint, " + ", ".join(f"{n} double" for n in FEATURES)
    found = rows.select("_at", F.col("_quality").cast("bigint").alias("_quality"), "text").mapInArrow(measure, schema)
    return sorted(found.groupBy("_at", "_quality").agg(F.min(F.struct(*FEATURES)).alias("f")).collect(), key=lambda r: r["_at"])


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; with too few samples to train on, their bytes as they are."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, [s[i:i + WINDOW] for s in samples for i in range(0, len(s), WINDOW)],
                                          k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:] or b" " * 64


def _scorer(model: CompressionModel):
    """texts -> array of scores."""
    pair, w = model.compressors(), np.array(model.weights)

    def scores(texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), model.blank)
        some = [i for i, t in enumerate(texts) if t]
        if some:
            f = np.array([features(texts[i], *pair) for i in some])
            out[some] = 1 / (1 + np.exp(-np.clip(w[0] + f @ w[1:], -30, 30)))
        return out

    return scores


def score_quality(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row. Only the text enters
    the score; null and empty texts get the score of the empty text, repeated
    rows equal scores; an empty table gives an empty result."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in batches:
            s = scores(batch.column("text").to_pylist())
            keep = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(s)], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (fold(F.col("doc_id")) == 1).alias("held_out"), "text")
    scored = rows.mapInArrow(score, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows over the ``documents`` and ``labels`` tables."""
    return score_quality(docs, fit(docs, labels))


def stage_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects. Null and empty
    texts have a score as others do; rows that repeat stay or go together; an
    empty table stays empty; all columns are kept, whatever their names."""
    model = fit(docs, labels)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column("text").to_pylist()) >= 0.5))

    return docs.mapInArrow(accept, docs.schema)
