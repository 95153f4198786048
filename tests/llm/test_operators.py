"""Operators against brute force on small tables with nulls, empty and long
texts, ties, repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from oracle_harness import compare, duck
from pyspark.sql import functions as F

from verdant.llm import common, components, cuckoo, licenses, mixing, ngram_join, packing, quality, suffix_dedup
from verdant.llm import url_rules, vector_files, warc
from verdant.llm.queries import ORACLE, QUERIES, TOKENIZER

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, digest string, `key` string"
BASE = " ".join(f"w{i}" for i in range(120))


def rows():
    near = BASE.replace("w60 ", "other ")
    texts = [(1, BASE), (2, BASE.upper()), (3, BASE), (4, near), (5, None), (6, ""), (7, " \t\n"), (8, "one two"),
             (9, "ONE two"), (10, "x" * 900), (11, "x" * 401), (12, "Z " + BASE + " end " * 90), (None, BASE), (3, BASE),
             (13, " ".join(f"v{i % 977}" for i in range(30_000))), (14, "Released under the MIT License.\nMore."),
             (15, "naïve 日本 <|endoftext|> it's 12")]
    return [(i, t, "en", s, 0, 0.5, "d", "k") for (i, t), s in zip(texts, ["a"] * 9 + ["b", "c", None] * 4)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DDL)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["ok"], r.get("error")


def test_exact_dedup(docs, none):
    groups = collections.defaultdict(list)
    for r in rows():
        groups[low(r[1])].append(r[0])
    want = collections.Counter((i, max((x for x in g if x is not None), default=None), len(g),
                                hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    got = cuckoo.op8_exact_dedup(docs).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert cuckoo.op8_exact_dedup(none).count() == 0
    kept = cuckoo.stage_exact_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_cuckoo_index_inserts_deletes_and_grows():
    index, live, rnd = cuckoo.CuckooIndex(2), {}, random.Random(1)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for step in range(12_000):
        k = rnd.choice(keys)
        if rnd.random() < 0.3:
            assert index.delete(k) == (live.pop(k, None) is not None)
        else:
            index.insert(k, step, "r", 1)
            live[k] = live.get(k, 0) + 1
    assert {e[0]: e[3] for e in index.entries()} == live and index.resizes > 3
    assert all((index.find(k) is not None) == (k in live) for k in keys)


def test_index_follows_takedowns(spark, docs):
    light = cuckoo.digests(docs.withColumn(common.ROW, F.monotonically_increasing_id().cast("string")))
    gone = light.filter("doc_id = 8").select("digest")
    index = common.written(cuckoo.build_index(light, 3), "i")
    new = cuckoo.update_index(index, light.filter("doc_id = 1"), gone, 3)
    sizes = {bytes(r.digest): r.group_size for r in new.collect()}
    assert hashlib.sha256(b"one two").digest() not in sizes
    assert sizes[hashlib.sha256(BASE.encode()).digest()] == 6


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(items):
    sets = [shingle_set(t) for _, t in items]
    at = list(range(len(items)))

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                at[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(items):
        least[root(i)].append(d)
    return collections.Counter((d, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None))
                               for i, (d, _) in enumerate(items))


def test_ngram_join(spark, docs, none):
    got = ngram_join.op6_ngram_join(docs).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components([(r[0], r[1]) for r in rows()])
    assert ngram_join.op6_ngram_join(none).count() == 0
    kept = ngram_join.stage_near_duplicates(docs)
    assert kept.columns == docs.columns


def test_ngram_join_large_group_of_near_copies(spark, monkeypatch):
    # Small blocks and early heavy shingles: the ways for hot groups, exactly.
    monkeypatch.setattr(ngram_join, "HEAVY_COUNT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rnd = random.Random(3)
    words, items = [f"w{i}" for i in range(60)], []
    for i in range(90):
        own = list(words)
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(60)] = f"y{rnd.randrange(1000)}"
        items.append((i, " ".join(own[: rnd.randint(50, 60)])))
    items += [(100 + i, " ".join([*words[:12], *(f"z{i}_{k}" for k in range(40))])) for i in range(30)]
    got = ngram_join.op6_ngram_join(spark.createDataFrame(items, "doc_id bigint, text string")).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(items)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 50), (70, 70)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50}


@pytest.mark.parametrize("chunk", [4, 32_768])
def test_suffix_dedup(spark, chunk):
    rnd = random.Random(5)
    shared = "".join(rnd.choice("abcd é") for _ in range(90))
    texts = [shared, "q" + shared + "r", shared[:50] + "!" + shared[40:], "ab" * 60, "ab" * 33, "", None, "short", "same " * 12,
             "same " * 12, *("".join(rnd.choice("xyz") for _ in range(60)) + shared[10:45 + i] for i in range(9))]
    length = 30
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    want = collections.Counter()
    for k, d in enumerate(data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        want[(k % 17, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)] += 1
    table = spark.createDataFrame([(k % 17, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, digest string")
    got = suffix_dedup.suffix_dedup(table, length=length, gram=8, chunk=chunk)
    assert collections.Counter((*tuple(r)[:5], bytes(r.kept)) for r in got.collect()) == want
    assert suffix_dedup.op4_suffix_dedup(table.limit(0)).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer
    ids = {}
    for r in rows():
        ids.setdefault(r[0], []).append([*Tokenizer.from_file(TOKENIZER).encode(r[1] or "", add_special_tokens=False).ids, 1])
    cut = packing.pieces(docs, TOKENIZER)
    packed = common.written(packing.pack(cut, group_pieces=4), "packed")
    places = collections.defaultdict(list)
    for r in packed.collect():
        part = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(part) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        assert any(x[r.start:r.start + r.length] == part and len(x) == r.doc_tokens for x in ids[r.doc_id])
        places[r.sequence_id].append((r.offset, r.length))
    assert sum(n for p in places.values() for _, n in p) == sum(len(x) for v in ids.values() for x in v)
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at
            at += n
        assert at <= 2048
    for r in packing.sequences(packed).collect():
        assert len(r.input_ids) in (2048, r.n_ids)
    assert packing.op3_packing(none, TOKENIZER).count() == 0


def test_packing_fills_windows():
    rnd = np.random.default_rng(2)
    sizes = rnd.integers(1, 2048, 500)
    windows = packing.fill(sizes, 2048)
    assert max(sum(x[2] for x in w) for w in windows) <= 2048
    assert sizes.sum() / (2048 * len(windows)) > 0.98
    got = collections.defaultdict(list)
    for w in windows:
        for item, start, n in w:
            got[item].append((start, n))
    assert all(sum(n for _, n in got[i]) == s for i, s in enumerate(sizes))


def test_quality(spark, docs, none):
    good = [(i, " ".join(random.Random(i).choices(["the", "river", "runs", "to", "sea", "and", "hills"], k=200)), 1) for i in range(300)]
    bad = [(1000 + i, "!!".join(random.Random(i).choices(["BUY", "NOW", "CHEAP", "$$$"], k=200)), 0) for i in range(300)]
    table = spark.createDataFrame(good + bad, "doc_id bigint, text string, quality int")
    labels = table.select("doc_id", "quality")
    got = {r.doc_id: r for r in quality.op7_quality_classifier(table.drop("quality"), labels).collect()}
    assert sum(got[i].predicted == q for i, _, q in good + bad) > 590
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in got.items())
    # No labels at all, nulls and empty texts: every row still has a score.
    odd = quality.op7_quality_classifier(docs, labels.limit(0)).collect()
    assert len(odd) == len(rows()) and all(r.score is not None for r in odd)
    assert quality.op7_quality_classifier(none, labels).count() == 0
    assert quality.stage_quality(docs, labels.limit(0)).columns == docs.columns


def test_warc(spark):
    long = "<p>é</p>" * 300
    pages = spark.createDataFrame([(1, "http://a\r\nX: y", long, 1), (5, "u", long, 1), (3, None, long, 1), (None, "n", long, 1),
                                   (5, "u", long, 1), (6, "u", None, 1), (7, "u", "short", 1), (8, "u", "short", 1)],
                                  "page_id bigint, url string, html string, keep int")
    manifest = warc.write_archives(pages, common.work_dir(spark, "warc"))
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in
                  warc.read_archives(manifest).collect()), key=str)
    size, sha = len(long.encode()), hashlib.sha1(long.encode()).hexdigest()
    short = (5, hashlib.sha1(b"short").hexdigest())
    assert got == sorted([(1, "revisit", 5, size, sha), (5, "response", None, size, sha), (3, "revisit", 5, size, sha),
                          (0, "revisit", 5, size, sha), (5, "response", None, size, sha),
                          (6, "response", None, 0, hashlib.sha1(b"").hexdigest()), (7, "response", None, *short),
                          (8, "response", None, *short)], key=str)
    assert warc.op1_warc(pages.limit(0)).count() == 0


def test_warc_dictionary_frame(tmp_path):
    records = [warc.record(i, "u", f"<html><body>{'text ' * 50}{i}</body></html>" * 20, 1, "00" * 20, None) for i in range(400)]
    path = f"{tmp_path}/x.warc.zst"
    size, dictionary = warc.write_file(path, records)
    assert dictionary and open(path, "rb").read(4) == (0x184D2A5D).to_bytes(4, "little")
    assert [h["WARC-Record-ID"] for h, _ in warc.read_file(path)] == [f"<urn:page:{i}>" for i in range(400)]


def test_url_rules_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "RANGE_ROWS", 40)
    rnd = random.Random(4)
    hosts = ["net", "a.net", "b.a.net", "xnet", "a.b.org", "org", "", "example.NET", "a,b.net", "net:80", "x.com"]
    urls = [(i, rnd.choice(["http://", "ftp://", "//", ""]) + rnd.choice(hosts if i % 3 else ["b.a.net"]) + rnd.choice(["", "/", "/en/x", "?q=/en/", "/e"]))
            for i in range(400)] + [(None, None), (7, "http://a.net/en/")]
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("a.net", "/en/", "block"), ("org", "", "block"), ("b.a.net", "", "allow")]
    table = spark.createDataFrame(urls, "page_id bigint, url string")
    got = url_rules.judge_urls(table, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = low(host)
        fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[3:] if fit else (None, "allow")))

    assert collections.Counter(tuple(r) for r in got) == collections.Counter((i, *brute(u)) for i, u in urls)
    assert url_rules.op2_url_rules(table.limit(0)).count() == 0


def test_top_k(spark):
    rnd = np.random.default_rng(3)
    table = [(i, [float(x) for x in rnd.normal(size=6).round(1)]) for i in range(300)]
    table += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0]), (305, []),
              (306, [1e30] * 6), (50, table[50][1])]
    got = vector_files.op9_top_k(spark.createDataFrame(table, "vec_id bigint, embedding array<float>").repartition(3)).collect()
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in table
          if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = collections.Counter()
    for a, (i, v) in enumerate(ok):
        if i % 50 == 0:
            best = sorted((-min(sum(x * y for x, y in zip(v, w)), 2**63 - 1), j) for b, (j, w) in enumerate(ok) if a != b)[:5]
            want.update((i, rank + 1, j, max(-s, -2**63)) for rank, (s, j) in enumerate(best))
    assert collections.Counter(tuple(r) for r in got) == want


def test_licenses(docs, none, spark):
    got = {r.doc_id: r for r in licenses.op5_license_scan(docs).collect()}
    assert got[14].licenses == "MIT" and got[5].licenses == "" and got[5].n_matches == 0
    text = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Copyright X. "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
            "the Software.\nLICENSED under CC-BY-NC 4.0.")
    r = licenses.op5_license_scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (r.licenses, r.n_matches, r.n_sentences) == ("MIT,CC-BY-NC-4.0", 2, 3)
    assert licenses.op5_license_scan(none).count() == 0


def test_mixing(spark, docs, none):
    table = spark.createDataFrame([(i, "w " * 10, "big" if i % 3 else "small" if i % 2 else None) for i in range(600)] + [(601, "", "zero")],
                                  "doc_id bigint, text string, source string")
    out = mixing.op10_mix_sources(table).collect()
    seen = collections.Counter(r.doc_id for r in out)
    assert set(seen) == {*range(600), 601} and max(seen.values()) <= 2 and seen[601] == 1
    # Within a pass, starts are gapless.
    for key in {(r.source, r["pass"]) for r in out}:
        at = 0
        for r in sorted((r for r in out if (r.source, r["pass"]) == key), key=lambda r: (r.start, r.tokens)):
            assert r.start == at
            at += r.tokens
    sources = spark.createDataFrame([("a", 900, 9), ("b", 100, 1)], "source string, tokens bigint, n bigint")
    exponent, most, _ = mixing.fit_exponent(sources, target_entropy=1.0, max_passes=3.0)
    assert most == 900 and abs(9 ** (1 - exponent) - 3) < 1e-5
    got = {r.source: r for r in mixing.weights(sources, 1.0, 4.0, budget=500).collect()}
    assert got["a"].budget + got["b"].budget <= 500 and got["a"].whole == 0
    assert mixing.op10_mix_sources(docs).count() >= len(rows())
    assert mixing.op10_mix_sources(none).count() == 0
