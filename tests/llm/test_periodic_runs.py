"""Periodic runs against a plain search of every period at every place."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from verdant.llm import periodic_runs as pr

SCHEMA = "doc_id bigint, text string"


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(12, 2 * q) and not any(
                    q % d == 0 and all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, planted):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def stitched_plain(words: list) -> list[tuple[int, int, int]]:
    """The operator's steps on one text, without Spark: tiles, solving, stitching."""
    found = []
    for p, lo, ids, at in pr.tiles(pr.numbered(words)):
        found += [(q, lo + a, lo + b) for q, a, b in pr.solve(p, ids, at)]
    out: list[tuple[int, int, int]] = []
    for q, a, b in sorted(found):
        if out and out[-1][0] == q and a <= out[-1][2] - q:
            out[-1] = (q, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((q, a, b))
    return sorted(((a, b - a, q) for q, a, b in out), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90))
def test_small_alphabets(words):
    words = [b"%d" % w for w in words]
    assert stitched_plain(words) == brute_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 9)), max_size=6))
def test_repeated_pieces(parts):
    words = [b"%d" % w for piece, times in parts for w in piece * times][:400]
    assert stitched_plain(words) == brute_runs(words)


def test_long_text_crosses_tiles():
    rng = random.Random(5)
    unit = [b"%d" % rng.randrange(1000) for _ in range(700)]
    words = [b"x"] * 1500 + [b"%d" % i for i in range(3000)] + unit * 4 + unit[:333] + [b"end"] + [b"a", b"b", b"c"] * 900
    assert stitched_plain(words) == [(0, 1500, 1), (4500, 3133, 700), (7634, 2700, 3)]


def test_z_function():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        plain = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert pr.z_function(s) == plain


def test_candidates_leave_no_boundary_out():
    rng = np.random.default_rng(7)
    for _ in range(60):
        ids = rng.integers(0, 3, 200).astype(np.int32)
        a, q = int(rng.integers(0, 120)), int(rng.integers(1, 30))
        ids[a:a + 3 * q + 12] = np.resize(ids[a:a + q], 3 * q + 12)[:len(ids[a:a + 3 * q + 12])]
        windows = pr._Windows(ids)
        for p in pr.octaves(len(ids)):
            found = set(pr.candidates(ids, p, windows).tolist())
            for s, length, period in brute_runs(ids.tolist()):
                if p <= period < 2 * p:
                    assert {b for b in range(0, len(ids), pr.step(p)) if s <= b < s + length - period} <= found


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    short = [r for r in docs.select("doc_id", "text").collect() if len((r.text or "").split()) < 900]
    got = {r.doc_id: tuple(r) for r in pr.op11_periodic_runs(docs).collect()}
    assert len(got) == docs.count()
    wanted = [brute_row(r.doc_id, r.text, True) for r in short]
    assert [got[w[0]] for w in wanted] == wanted
    assert any(w[1] for w in wanted)


def test_edge_cases(spark):
    again = "to be or not " * 5
    rows = [(None, again), (7, None), (8, ""), (9, "  \t\n"), (1, "one two"), (2, again), (2, again),
            (3, "w " * 30000), (4, " ".join(f"u{i}" for i in range(5000)) + " a b" * 20000),
            (5, "é à " * 8 + "  x")]
    docs = spark.createDataFrame([(*r, "c", 0) for r in rows], SCHEMA + ", runs string, period int")
    got = pr.periodic_runs(docs).collect()
    assert sorted(map(repr, (tuple(r)[:8] for r in got))) == sorted(
        map(repr, ((*brute_row(*r, False),) if len(r[1] or "") < 30000 else next(tuple(g)[:8] for g in got if g.doc_id == r[0]) for r in rows)))
    by = {r.doc_id: r for r in got}
    assert (by[3].n_runs, by[3].length, by[3].period, bytes(by[3].kept)) == (1, 30000, 1, b"w")
    assert (by[4].n_runs, by[4].start, by[4].length, by[4].period) == (1, 5000, 40000, 2)
    assert bytes(by[2].kept) == b"to be or not" and by[7].n_runs == 0 and bytes(by[7].kept) == b""
    assert pr.op11_periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
