"""Language of a text: known words first, shorter and shorter n-grams for the rest.

Learning counts the words of all labelled documents per language, in Spark.
The most frequent words of every language make its vocabulary; from the
counted words, not from the texts, come the counts of character n-grams of
1 to ``MAX_GRAM`` letters, word ends included.

A text is judged word by word. A word of the vocabulary scores by its log
frequency in each language. Any other word backs off: the longest length at
which at least one of its n-grams is known decides, by the mean of the log
frequencies of the known ones. A word that not even has a known letter says
nothing. The language with the largest sum wins, ties go to the smaller name.

The model's size is bounded by ``WORD_ENTRIES`` and ``GRAM_ENTRIES`` per
length, shared out evenly among the languages, by ``TABLE_CELLS`` and by
``MAX_WORD`` letters a word; so it can be broadcast however many texts were
counted. A word beyond these bounds is an unseen word, which is what backing
off is for.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, rows_of, scratch, written

WORD_ENTRIES = 120_000      # (language, word) pairs of the model
GRAM_ENTRIES = 40_000       # (language, n-gram) pairs of the model, for every length
MAX_GRAM = 5                # letters of the longest n-gram
MAX_WORD = 40               # letters of the longest word that is counted
TABLE_CELLS = 4_000_000     # items times languages, for words and for every length; many languages share fewer items
CLASSES = 16                # classes of counts in an octave
ADD = 0.5                   # count that an unseen pair is given
HELD_COUNTS = 300_000       # different words a task counts before it hands them on
CACHE_WORDS = 200_000       # words whose evidence a worker remembers; only saves time
FOLDS = 5                   # documents of fold 0 are never learnt from
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
EDGE = "_"                  # stands at both ends of a word inside n-grams; no letter


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def word_bag(text: str | None) -> Counter:
    """How often each run of letters stands in a text, in lower case. Number
    signs such as a superscript two are no letters."""
    bag = Counter((text or "").lower().split())
    for token in list(filterfalse(str.isalpha, bag)):
        n = bag.pop(token)
        for run in _LETTERS.findall(token):
            for part in (run,) if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split():
                bag[part] += n
    return bag


def grams(word: str, length: int) -> list[str]:
    """Character n-grams of a word between its ends; single letters come without the ends."""
    edged = word if length == 1 else EDGE + word + EDGE
    return [edged[i:i + length] for i in range(len(edged) - length + 1)]


# ---------------------------------------------------------------------------
# Counting
# ---------------------------------------------------------------------------
COUNT_SCHEMA = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("item", pa.string()), ("n", pa.int64())])
COUNT_DDL = "lang string, length int, item string, n bigint"


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, length = 0, item, n): how often each word stands in the labelled
    documents outside fold 0. Tasks add up before anything is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held: dict[str, Counter] = {}
            for lang, text in rows_of(batches, "lang", "text"):
                held.setdefault(lang, Counter()).update(word_bag(text))
                if sum(map(len, held.values())) > HELD_COUNTS:
                    yield from handed_on(held)
                    held = {}
            yield from handed_on(held)

        def handed_on(held: dict[str, Counter]) -> Iterator[tuple]:
            return ((lang, 0, w, n) for lang, c in held.items() for w, n in c.items() if len(w) <= MAX_WORD)

        yield from batches_of(rows(), COUNT_SCHEMA)

    learnt = docs.filter((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = learnt.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(count, COUNT_DDL)
    return counts.groupBy("lang", "length", "item").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, max_gram: int = MAX_GRAM) -> DataFrame:
    """(lang, length, item, n) of the n-grams of counted words, as ``grams``
    cuts them. The longest ones, shortened at a word's end, are counted first;
    the shorter ones begin those, so they are cut from a small table."""
    edged = F.concat(F.lit(EDGE), "item", F.lit(EDGE))
    every = F.transform(F.sequence(F.lit(1), F.length("item") + 2), lambda at: F.substring(edged, at, F.lit(max_gram)))
    longest = words.select("lang", "n", F.explode(every).alias("item")).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    cut = longest.select("lang", "item", "n", F.explode(F.sequence(F.lit(1), F.length("item"))).alias("length"))
    cut = cut.select("lang", "length", F.substring("item", F.lit(1), F.col("length")).alias("item"), "n")
    return cut.filter(F.col("item") != EDGE).groupBy("lang", "length", "item").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------------------
# The model
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies in each language: ``known[length][item]`` is a row of
    ``table``; length 0 stands for words."""

    languages: tuple[str, ...]
    known: dict[int, dict[str, int]]
    table: np.ndarray

    def rows_for(self, word: str) -> list[int]:
        """The rows whose mean is a word's evidence: its own if the word is known,
        else those of its longest known n-grams; none if no letter is known."""
        at = self.known[0].get(word)
        if at is not None:
            return [at]
        for length in range(MAX_GRAM, 0, -1):
            known = self.known[length]
            found = [known[g] for g in grams(word, length) if g in known]
            if found:
                return found
        return []

    def evidence(self, words: list[str]) -> np.ndarray:
        """One row per word: its log frequency in each language."""
        rows = [self.rows_for(w) for w in words]
        counts = np.array([len(r) for r in rows])
        out = np.zeros((len(words), len(self.languages)))
        some = np.flatnonzero(counts)
        if len(some):
            flat = np.array([i for r in rows for i in r])
            starts = np.cumsum(counts[some]) - counts[some]
            out[some] = np.add.reduceat(self.table[flat].astype(np.float64), starts) / counts[some, None]
        return out


class Judge:
    """Judges texts by a model and remembers the evidence of words, also from
    one task of a worker process to the next."""

    def __init__(self, model: LanguageModel, remembered: int = CACHE_WORDS):
        self.model, self.place, self.remembered = model, {}, remembered
        self.rows: np.ndarray | None = None

    def _rows(self, bag: Counter) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(evidence, times) of the words, as many at a time as can be remembered."""
        words, times = list(bag), list(bag.values())
        for start in range(0, len(words), self.remembered):
            part = words[start:start + self.remembered]
            at = list(map(self.place.get, part))
            if None in at:
                new = [w for w, k in zip(part, at, strict=True) if k is None]
                if len(self.place) + len(new) > self.remembered:
                    self.place.clear()
                    new = part
                known = len(self.place)
                if self.rows is None:
                    self.rows = np.zeros((self.remembered, len(self.model.languages)))
                self.rows[known:known + len(new)] = self.model.evidence(new)
                self.place.update(zip(new, range(known, known + len(new)), strict=True))
                at = list(map(self.place.get, part))
            yield self.rows[at], np.array(times[start:start + self.remembered], dtype=float)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, score). The score is the winner's share when the text's
        evidence is weighed by the square root of its number of words, since
        words of one text don't speak independently. ``und`` and 0 without a
        letter or without any learnt language."""
        bag, languages = word_bag(text), self.model.languages
        if not bag or not languages:
            return UNKNOWN, 0.0
        total = sum(times @ rows for rows, times in self._rows(bag))
        share = np.exp((total - total.max()) / math.sqrt(bag.total()))
        best = int(total.argmax())
        return languages[best], float(share[best] / share.sum())


def fit(docs: DataFrame, word_entries: int = WORD_ENTRIES, gram_entries: int = GRAM_ENTRIES) -> LanguageModel:
    """Count all labelled documents outside fold 0 and keep each language's most
    frequent words and n-grams: classes of counts, a ``CLASSES``-th of an octave
    wide, from the most frequent down, as long as a class fits as a whole.

    Null languages and null texts teach nothing; repeated rows count each time.
    Without any labelled text the model knows no language and every text is
    ``und``."""
    with scratch(docs.sparkSession):
        words = written(word_counts(docs), "language-words")
        counts = words.unionByName(written(gram_counts(words), "language-grams"))
        by_class = F.floor(F.log2("n") * CLASSES).cast("int").alias("class")
        sums = counts.groupBy("lang", "length", by_class).agg(F.sum("n").alias("total"), F.count("*").alias("items")).collect()
        languages = sorted({r.lang for r in sums})
        if not languages:
            return LanguageModel((), {}, np.zeros((0, 0)))
        # The least class that is kept, of every language and length.
        limits = F.lit(None).cast("int")
        for lang in languages:
            for length in range(MAX_GRAM + 1):
                share, least = min(gram_entries if length else word_entries, TABLE_CELLS // len(languages)) // len(languages), None
                for r in sorted((r for r in sums if r.lang == lang and r.length == length), key=lambda r: -r["class"]):
                    share -= r["items"]
                    if share < 0:
                        break
                    least = r["class"]
                limits = F.when((F.col("lang") == lang) & (F.col("length") == length), F.lit(least).cast("int")).otherwise(limits)
        kept = counts.filter(by_class >= limits).select("lang", "length", "item", "n").toArrow()
        return _model(languages, sums, kept)


def _model(languages: list[str], sums: list, kept: pa.Table) -> LanguageModel:
    place = {name: k for k, name in enumerate(languages)}
    unseen = np.zeros((MAX_GRAM + 1, len(languages)))
    for k in range(MAX_GRAM + 1):
        for name, at in place.items():
            mine = [r for r in sums if r.lang == name and r.length == k]
            unseen[k, at] = math.log(ADD) - math.log(sum(r.total for r in mine) + ADD * (sum(r["items"] for r in mine) + 1))
    known: dict[int, dict[str, int]] = {k: {} for k in range(MAX_GRAM + 1)}
    lang, length, item, n = (kept.column(c).to_pylist() for c in COUNT_SCHEMA.names)
    rows: list[int] = []
    lengths: list[int] = []
    for k, i in zip(length, item, strict=True):
        at = known[k].setdefault(i, len(lengths))
        if at == len(lengths):
            lengths.append(k)
        rows.append(at)
    table = unseen[lengths]
    # An item has one row per language at most, so no place is added to twice.
    table[rows, [place[name] for name in lang]] += np.log((np.array(n) + ADD) / ADD)
    return LanguageModel(tuple(languages), known, table.astype(np.float32))


# ---------------------------------------------------------------------------
# Judging
# ---------------------------------------------------------------------------
OUT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    Only the text enters a prediction, and all of it. Null and empty texts and
    texts without a letter are ``und`` with score 0. Repeated rows get equal
    answers, null ids stay null, an empty table gives an empty result; further
    columns may have any name."""
    # Loaded once by a worker process, not by every task.
    shared = docs.sparkSession.sparkContext.broadcast(Judge(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        yield from batches_of(((d, h, *judge(t)) for d, h, t in rows_of(batches, "doc_id", "held_out", "text")), OUT_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def op12_language_id(docs: DataFrame) -> DataFrame:
    """The query's rows over a ``documents`` table."""
    return identify(docs, fit(docs))
