"""Fill-in-the-middle: rotations, exact round trips, the query against SQL and a plain version."""

from __future__ import annotations

import hashlib
import re

from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from verdant.llm import fill_middle as fm

SCHEMA = "doc_id bigint, text string"


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "plain" if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 \
        else "spm" if h4 % 100 < 50 else "psm"
    out = {"plain": text, "psm": f"<P>{pre}<S>{suf}<M>{mid}", "spm": f"<S>{suf}<P>{pre}<M>{mid}"}[form]

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    lengths = (None, None) if form == "plain" else (len(pre), len(mid))
    return (doc_id, n, form, *lengths, sha(out), sha(text))


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=300), st.data())
def test_rotation(data, draw):
    a, b, c = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buffer = bytearray(data)
    fm.rotate(buffer, a, b, c)
    assert bytes(buffer) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_rotation_over_many_blocks():
    data = bytes(i * 7919 % 251 for i in range(3 * fm.BLOCK + 17))
    for cut in (1, 5, fm.BLOCK, 2 * fm.BLOCK + 3, len(data) - 1):
        buffer = bytearray(data)
        fm.rotate(buffer, 0, cut, len(data))
        assert bytes(buffer) == data[cut:] + data[:cut]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a\nb<PSM>é漢\r ", max_size=60), st.data())
def test_round_trip(text, draw):
    data = text.encode()
    n = fm.line_count(data)
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert n == len(lines)
    a, b = sorted((draw.draw(st.integers(0, n)), draw.draw(st.integers(0, n))))
    first, second = fm.line_ends(data, a, b)
    assert (data[:first].decode(), data[:second].decode()) == ("".join(lines[:a]), "".join(lines[:b]))
    if fm.has_sentinel(data):
        return
    for form in ("psm", "spm"):
        out = fm.transform(data, first, second, form)
        p, m, s = data[:first], data[first:second], data[second:]
        assert bytes(out) == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
        assert bytes(fm.restore(out, form)) == data


def test_line_ends_over_blocks():
    data = (b"x" * 40_000 + b"\n") * 9 + b"\n" * 70_000 + b"end"
    ends = [m.end() for m in re.finditer(rb"[^\n]*\n|[^\n]+", data)]
    for a, b in ((0, 0), (0, 3), (2, 9), (9, 60_000), (12, len(ends)), (len(ends), len(ends))):
        assert fm.line_ends(data, a, b) == (ends[a - 1] if a else 0, ends[b - 1] if b else 0)


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(tuple(r) for r in fm.op13_fill_middle(docs).collect())
    assert got == sorted(plain(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert {g[2] for g in got} >= {"psm", "spm"}


def test_odd_rows(spark):
    rows = [(None, "a\nb\n"), (1, None), (2, ""), (3, "\n"), (4, "no line end"), (5, "a<S>b\nc"), (6, "x\ny\nz\n"), (6, "x\ny\nz\n"),
            (7, "é漢\n" * 200_000), (8, "w" * 2_000_000), (9, "<\nP>\n<P\n>"), (10, "\r\n \r\n")]
    docs = spark.createDataFrame([(*r, "plain", 3) for r in rows], SCHEMA + ", form string, n int")
    got = sorted((tuple(r) for r in fm.op13_fill_middle(docs).collect()), key=repr)
    assert got == sorted((plain(*r) for r in rows), key=repr)
    assert all(r[6] == hashlib.sha256((t or "").encode()).hexdigest() for r, (_, t) in zip(
        sorted(got, key=repr), sorted(rows, key=lambda x: repr(plain(*x))), strict=True))
    assert fm.op13_fill_middle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_texts_come_back(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    back = fm.restored(fm.fill_in_middle(docs))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.collect()))


def test_share_of_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    forms = [r.form for r in fm.fill_in_middle(docs, fim_percent=50, spm_percent=0).select("form").collect()]
    assert set(forms) == {"plain", "psm"} and 0.3 < forms.count("plain") / len(forms) < 0.7
