"""Odd tables and internal borders: payloads above a file's size, very long urls,
empty tables, clashing columns, texts above a piece, many hash ranges."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_operators import DDL, rows

from verdant.llm import common, mixing, packing, quality, suffix_dedup, url_rules, vector_files, warc
from verdant.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DDL)


def test_archives_are_read_in_as_many_tasks_as_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rnd = random.Random(3)
    html = [(i, f"http://x/{i}", "".join(rnd.choices("abcdef <>", k=4_000))) for i in range(60)]
    html += [(100, None, "z" * 90_000), (101, "u", None), (102, "u", "")]       # one payload above a file's size
    pages = spark.createDataFrame(html, "page_id bigint, url string, html string")
    manifest = warc.write_archives(pages, common.work_dir(spark, "warc"))
    back = warc.read_archives(manifest)
    assert back.rdd.getNumPartitions() == manifest.count() > 10
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in back.collect())
    assert got == collections.Counter((i, len(t or ""), hashlib.sha1((t or "").encode()).hexdigest()) for i, _, t in html)


def test_number_of_url_ranges_follows_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "RANGE_ROWS", 1)
    monkeypatch.setattr(url_rules, "RANGES_PER_CORE", 1)
    urls = [(i, f"http://h{i % 7}.example.net/en/{i}", "x", 0) for i in range(400)]
    urls += [(500, "http://example.com/de/" + "a" * 300_000, "x", 0), (501, "http://" + "b." * 100_000 + "org/fr/", "x", 0),
             (None, None, "x", 0), (502, "", "x", 0), (502, "", "x", 0)]
    pages = spark.createDataFrame(urls, "page_id bigint, url string, verdict string, `key` int")
    assert url_rules.most_ranges(spark) < len(urls)
    got = collections.Counter((r.page_id, r.rule, r.verdict) for r in url_rules.op2_url_rules(pages).collect())
    want = collections.Counter((i, "example.net/en/", "allow") for i in range(400))
    want.update([(500, "example.com/de/", "block"), (501, "org/fr/", "allow"), (None, None, "allow"), (502, None, "allow"), (502, None, "allow")])
    assert got == want


def test_top_k_of_empty_tables_and_clashing_names(spark):
    ddl = "vec_id bigint, embedding array<float>, block int, kind int, score double, parts string"
    assert vector_files.op9_top_k(spark.createDataFrame([], ddl)).count() == 0
    table = spark.createDataFrame([(0, [1.0, 0.0], 9, 9, 0.5, "p"), (1, [0.5, 0.5], 9, 9, 0.5, "p"), (2, [0.5, -0.5], 9, 9, 0.5, "p")], ddl)
    got = sorted(tuple(r) for r in vector_files.op9_top_k(table).collect())
    assert got == [(0, 1, 1, 256 * 128), (0, 2, 2, 256 * 128)]


def test_repeats_across_the_border_of_a_piece(spark, monkeypatch):
    rnd = random.Random(9)
    shared = "".join(rnd.choices("abcdefgh", k=500))
    long = "".join(rnd.choices("ijklmnop", k=900))
    texts = [long + shared + long[::-1], "q" * 10 + shared, "clean " * 20]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = [tuple(r) for r in suffix_dedup.op4_suffix_dedup(table).orderBy("doc_id").collect()]
    assert [r[2] for r in want] == [500, 500, 0]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1_000)
    assert [tuple(r) for r in suffix_dedup.op4_suffix_dedup(table).orderBy("doc_id").collect()] == want


def test_passages_of_many_words_go_by_their_bytes(spark):
    # Over 50 words each, in two texts: 399 bytes stay, 400 go; a smaller length takes both.
    rnd = random.Random(8)
    passages = ["".join(rnd.choices("abcdef", k=n)) for n in (399, 400)]
    passages = [" ".join(p[i:i + 5] for i in range(0, len(p), 6)).ljust(len(p), "z") for p in passages]
    assert [len(p) for p in passages] == [399, 400] and min(len(p.split()) for p in passages) > 50
    texts = [a + p + b for p in passages for a, b in ("gk", "hl")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.op4_suffix_dedup(table).collect()}
    assert removed == {0: 0, 1: 0, 2: 400, 3: 400}
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.suffix_dedup(table, length=256).collect()}
    assert removed == {0: 399, 1: 399, 2: 400, 3: 400}


def test_a_passage_in_most_texts_is_not_dealt_to_one_task(spark):
    ddl = "uid bigint, anchor bigint, p bigint, s0 bigint, s1 bigint"
    rows = [(i, 7 if i % 4 else 1000 + i // 8, 9, 0, i % 5) for i in range(4000)] + [(4000, 5, 0, 0, 0)]
    anchors = common.written(spark.createDataFrame(rows, ddl).repartition(8), "anchors")
    shared = suffix_dedup.shared_segments(anchors, chunk=100)
    total = collections.Counter(r[1] for r in rows)
    assert collections.Counter((r.uid, r.anchor, r.p, r.s0, r.s1, r.hot) for r in shared.collect()) == collections.Counter(
        (*r, total[r[1]] > 100) for r in rows if total[r[1]] > 1)
    placed = collections.Counter(r[0] for r in shared.filter("hot").select(F.spark_partition_id()).collect())
    assert sum(placed.values()) == 3000 and max(placed.values()) < 1000

    places = [(r[0], a) for r in rows if r[1] == 7 for a in range(r[4] + 1)]
    strings = spark.createDataFrame([(u, a, a % 2, u if u % 50 == 1 else 0) for u, a in places], "uid bigint, a bigint, h1 bigint, h2 bigint")
    crowded = anchors.filter("anchor = 7").select("uid", "s0", "s1")
    runs = suffix_dedup.hot_runs(crowded, strings)
    times = collections.Counter((a % 2, u if u % 50 == 1 else 0) for u, a in places)
    got = collections.Counter((r.uid, a) for r in runs.collect() for a in range(r.a, r.b + 1))
    assert got == collections.Counter((u, a) for u, a in places if times[a % 2, u if u % 50 == 1 else 0] > 1)
    assert 0 < sum(got.values()) < len(places)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and ("h1" in x or "h2" in x)]


def test_hot_passage_with_own_endings_equals_brute_force(spark):
    # One passage in every text, some of them copied in two texts with what follows, and twice in one.
    rnd = random.Random(4)
    passage = "".join(rnd.choices("abcdé ", k=420))
    tails = ["".join(rnd.choices("xyz", k=300)) for _ in range(20)]
    texts = [f"{i:05d}" + passage + tails[i % 20][:rnd.randint(1, 300)] + f"{i:05d}" for i in range(40)] + [passage + "-" + passage, None, "", passage[:399]]
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i:i + 400] for d in data for i in range(len(d) - 399))
    want = collections.Counter()
    for k, d in enumerate(data):
        gone = bytearray(len(d))
        for i in range(len(d) - 399):
            if count[d[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        want[(k, len(d), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest())] += 1
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for chunk in (8, 32_768):
        got = suffix_dedup.suffix_dedup(table, chunk=chunk)
        assert collections.Counter(tuple(r)[:5] for r in got.collect()) == want


def test_starts_are_the_same_over_many_hash_ranges(spark, monkeypatch):
    table = spark.createDataFrame([(i, "w " * (i % 13), "big" if i % 3 else None) for i in range(900)],
                                  "doc_id bigint, text string, source string")
    want = collections.Counter(tuple(r) for r in mixing.op10_mix_sources(table).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)       # three digits: heads of one, tails of two
    assert collections.Counter(tuple(r) for r in mixing.op10_mix_sources(table).collect()) == want


def test_stages_take_odd_rows(spark, docs):
    none = spark.createDataFrame([], DDL)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    for table, n in ((docs, len(rows())), (none, 0)):
        mixed = mixing.stage_mix(table)
        assert mixed.columns == table.columns and mixed.count() >= n
        kept = quality.stage_quality(table, labels)
        assert kept.columns == table.columns and kept.count() <= n
    pieces = packing.op3_packing(mixing.stage_mix(docs), TOKENIZER)
    assert pieces.filter("doc_id IS NULL").count() > 0 and pieces.filter("doc_id = 5").first().doc_tokens == 1
