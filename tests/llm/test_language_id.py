"""Language identification: counts, backing off, held-out accuracy, odd rows."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
from conftest import SF_SMALL

from verdant.llm import language_id as li

SCHEMA = "doc_id bigint, text string, lang string"


def plain_words(text):
    out, run = collections.Counter(), ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            run += c
        elif run:
            out[run] += 1
            run = ""
    return out


def test_word_bag():
    for text in (None, "", "Über-ALLES, 3x x² _a_b ½ c½d", "l'été—là bas", "a" * 5000 + "1b", "日本語 テキスト"):
        assert li.word_bag(text) == plain_words(text)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = li.op12_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_model_against_plain_counts(spark):
    """The whole model, recomputed without Spark, and its verdicts."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = li.fit(docs)
    words, grams = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    rows = docs.select("doc_id", "text", "lang").collect()
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None:
            words[r.lang].update({w: n for w, n in plain_words(r.text).items() if len(w) <= li.MAX_WORD})
    for lang, c in words.items():
        for w, n in c.items():
            for k in range(1, li.MAX_GRAM + 1):
                edged = w if k == 1 else f"_{w}_"
                for i in range(len(edged) - k + 1):
                    grams[lang, k][edged[i:i + k]] += n
    assert model.languages == tuple(sorted(words))
    for at, lang in enumerate(model.languages):
        for k in range(li.MAX_GRAM + 1):
            counts = words[lang] if k == 0 else grams[lang, k]
            room = (li.GRAM_ENTRIES if k else li.WORD_ENTRIES) // len(words)
            classes = collections.Counter(math.floor(math.log2(n) * li.CLASSES) for n in counts.values())
            least = None
            for c in sorted(classes, reverse=True):
                room -= classes[c]
                if room < 0:
                    break
                least = c
            total = sum(counts.values()) + li.ADD * (len(counts) + 1)
            kept = {i: n for i, n in counts.items() if least is not None and math.floor(math.log2(n) * li.CLASSES) >= least}
            for item, row in model.known[k].items():
                assert math.isclose(model.table[row, at], math.log((kept.get(item, 0) + li.ADD) / total), rel_tol=1e-5)
            assert set(kept) <= set(model.known[k])
    judge = li.Judge(model)
    for r in rows[:60]:
        total = np.zeros(len(model.languages))
        for w, n in plain_words(r.text).items():
            total += n * plain_evidence(model, w)
        assert judge(r.text)[0] == (model.languages[int(total.argmax())] if plain_words(r.text) else "und")


def plain_evidence(model, word):
    if word in model.known[0]:
        return model.table[model.known[0][word]].astype(float)
    for k in range(li.MAX_GRAM, 0, -1):
        edged = word if k == 1 else f"_{word}_"
        rows = [model.table[model.known[k][g]].astype(float) for i in range(len(edged) - k + 1)
                if (g := edged[i:i + k]) in model.known[k]]
        if rows:
            return np.mean(rows, axis=0)
    return np.zeros(len(model.languages))


def test_little_memory_gives_the_same(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = li.fit(docs)
    small, large = li.Judge(model, remembered=7), li.Judge(model)
    for r in docs.select("text").limit(40).collect():
        (a, x), (b, y) = small(r.text), large(r.text)
        assert a == b and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12)


def test_backs_off_for_unseen_words(spark):
    docs = spark.createDataFrame([(i, "schule schnell schon deutsch", "de") for i in range(20)]
                                 + [(i + 50, "thing other weather theory", "en") for i in range(20)], SCHEMA)
    judge = li.Judge(li.fit(docs))
    assert judge("schatten")[0] == "de" and judge("then")[0] == "en"
    assert judge("schule")[0] == "de"
    assert judge("漢字") == ("de", 0.5)            # no known letter: a tie goes to the smaller name


def test_odd_rows(spark):
    rows = [(None, "the weather", "en"), (1, None, "en"), (2, "", "de"), (3, " 12 ²½ ... ", "de"), (4, "the weather", "en"),
            (4, "the weather", "en"), (5, "das wetter " * 200_000, "de"), (6, "das wetter", "de"), (7, "x", None),
            (8, "the rain and the sun", "en"), (9, "der regen und die sonne", "de"), (11, "w" * 3000, "en")]
    # Ids outside fold 0, so both languages are learnt.
    rows += [(i, "das wetter ist schön", "de") for i in (21, 22, 23)] + [(i, "the weather is fine", "en") for i in (31, 32, 33)]
    assert any(zlib.crc32(str(i).encode()) % 5 for i in (21, 22, 23)) and any(zlib.crc32(str(i).encode()) % 5 for i in (31, 32, 33))
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA + ", score int, lang_pred string")
    got = li.op12_language_id(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert {r.lang_pred for r in got if r.doc_id in (5, 6)} == {"de"}
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 4}) == 1
    assert {r.lang_pred for r in got if r.doc_id in (4, 31, 32, 33, None)} == {"en"}


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "the weather", None), (2, "das wetter", None)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in li.op12_language_id(docs).collect()} == {("und", 0.0)}
    assert li.op12_language_id(spark.createDataFrame([], SCHEMA)).collect() == []


def test_only_the_text_is_judged(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    model = li.fit(docs)
    turned = docs.selectExpr("-doc_id AS doc_id", "text", "'xx' AS lang")
    a = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(docs, model).collect()}
    b = {-r.doc_id: (r.lang_pred, r.score) for r in li.identify(turned, model).collect()}
    assert a == b
