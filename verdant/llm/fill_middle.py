"""Fill-in-the-middle transformation by block rotation in place.

A text is cut at two line ends into prefix, middle and suffix. Its bytes lie
in one bytearray into which the three sentinels are inserted, in the order
of the text: prefix, middle, suffix. Exchanging two neighbouring segments is
a rotation, done in place by three reversals, so whatever order a form asks
for costs one pass and a fixed amount of scratch:

* psm (prefix, suffix, middle) rotates middle and suffix;
* spm (suffix, prefix, middle) rotates the suffix to the front.

Restoring finds the sentinels, rotates back, and takes the sentinels out.
Texts that hold a sentinel themselves stay as they are (``plain``), so the
sentinels of an output are found without doubt.

The work is per row: no shuffle, nothing held beyond one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, rows_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "7"              # names the draw of cuts and forms
FIM_PERCENT = 100       # share of texts that are transformed
SPM_PERCENT = 50        # share of those in the order suffix, prefix, middle
BLOCK = 1 << 16         # bytes moved at a time
BATCH = 256             # rows of a result batch; outputs are as long as the texts


# ---------------------------------------------------------------------------
# Rotations in place
# ---------------------------------------------------------------------------
def reverse(view: np.ndarray, start: int, end: int) -> None:
    """Reverse ``view[start:end]`` in place, with scratch for one block."""
    while end - start > 1:
        size = min(BLOCK, (end - start) // 2)
        left = view[start:start + size].copy()
        view[start:start + size] = view[end - size:end][::-1]
        view[end - size:end] = left[::-1]
        start, end = start + size, end - size


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange ``buffer[start:cut]`` and ``buffer[cut:end]`` in place: reverse
    each, then both together."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    reverse(view, start, cut)
    reverse(view, cut, end)
    reverse(view, start, end)


# ---------------------------------------------------------------------------
# One text
# ---------------------------------------------------------------------------
def line_count(data: bytes | bytearray) -> int:
    """Lines of a text; a last line needs no line end."""
    return data.count(b"\n") + (len(data) > 0 and not data.endswith(b"\n"))


def line_ends(data: bytes | bytearray, first: int, second: int) -> tuple[int, int]:
    """Byte offsets after ``first`` and ``second`` lines, ``first <= second``."""
    ends, seen, at = [], 0, 0
    for wanted in (first, second):
        while seen < wanted:
            # Whole blocks are skipped by their count of line ends.
            inside = data.count(b"\n", at, at + BLOCK)
            if seen + inside < wanted and at + BLOCK < len(data):
                seen, at = seen + inside, at + BLOCK
                continue
            found = data.find(b"\n", at)
            at = len(data) if found < 0 else found + 1
            seen += 1
        ends.append(at)
    return ends[0], ends[1]


def has_sentinel(data: bytes) -> bool:
    return any(s in data for s in (PREFIX, SUFFIX, MIDDLE))


def transform(data: bytes, first: int, second: int, form: str) -> bytearray:
    """The text's output: cut after ``first`` and ``second`` bytes, sentinels in, rotated."""
    buffer = bytearray(data)
    # From the back, so earlier offsets hold: prefix, middle, suffix in text order.
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def restore(output: bytes | bytearray, form: str) -> bytearray:
    """The exact text, from an output and its form alone."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    p, s, m = (buffer.find(x) for x in (PREFIX, SUFFIX, MIDDLE))
    start, cut = (s, m) if form == "psm" else (s, p)
    rotate(buffer, start, cut, len(buffer))
    for sentinel in (PREFIX, MIDDLE, SUFFIX):
        at = buffer.find(sentinel)
        del buffer[at:at + len(sentinel)]
    return buffer


def code_points(data: bytes | memoryview) -> int:
    """Characters of UTF-8 bytes: all but continuation bytes begin one."""
    view = np.frombuffer(data, dtype=np.uint8)
    return sum(int(np.count_nonzero((view[at:at + (1 << 20)] & 0xC0) != 0x80)) for at in range(0, len(view), 1 << 20))


# ---------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------
def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned numbers of 32 bits drawn by the id; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


FIM_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])
FIM_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"


def fill_in_middle(docs: DataFrame, seed: str = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` counts lines, ``output`` holds the transformed UTF-8 bytes. Null texts
    count as empty; empty texts, and texts that hold a sentinel, are ``plain``,
    with null lengths. A null id draws as the empty text; repeated rows and ids
    give equal outputs; an empty table gives an empty result. Only ``doc_id``
    and ``text`` are read, so further columns may have any name."""
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("data"),
                       h1.alias("h1"), h2.alias("h2"), (h3 % 100 < fim_percent).alias("fim"),
                       (h4 % 100 < spm_percent).alias("spm"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for doc_id, data, h1, h2, fim, spm in rows_of(batches, "doc_id", "data", "h1", "h2", "fim", "spm"):
                n = line_count(data)
                if not data or not fim or has_sentinel(data):
                    yield doc_id, n, "plain", None, None, data
                    continue
                first, second = line_ends(data, *sorted((h1 % (n + 1), h2 % (n + 1))))
                form, whole = "spm" if spm else "psm", memoryview(data)
                yield (doc_id, n, form, code_points(whole[:first]), code_points(whole[first:second]),
                       bytes(transform(data, first, second, form)))

        yield from batches_of(out(), FIM_SCHEMA, BATCH)

    return rows.mapInArrow(run, FIM_DDL)


RESTORED_SCHEMA = pa.schema([*list(FIM_SCHEMA)[:5], ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
RESTORED_DDL = FIM_DDL.removesuffix(", output binary") + ", output_sha256 string, restored_sha256 string"


def restored(outputs: DataFrame) -> DataFrame:
    """(doc_id, text) rebuilt from ``output`` and ``form`` alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])
        yield from batches_of(((d, bytes(restore(o, f))) for d, f, o in rows_of(batches, "doc_id", "form", "output")), schema, BATCH)

    return outputs.select("doc_id", "form", "output").mapInArrow(run, "doc_id bigint, text binary") \
        .select("doc_id", F.col("text").cast("string").alias("text"))


def digests(outputs: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with the SHA-256 of the output and of the text restored from it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for *head, form, prefix, middle, output in rows_of(batches, *FIM_SCHEMA.names):
                yield (*head, form, prefix, middle, hashlib.sha256(output).hexdigest(),
                       hashlib.sha256(restore(output, form)).hexdigest())

        yield from batches_of(out(), RESTORED_SCHEMA, 4096)

    return outputs.mapInArrow(run, RESTORED_DDL)


def op13_fill_middle(docs: DataFrame) -> DataFrame:
    """The query's rows over a ``documents`` table."""
    return digests(fill_in_middle(docs))


_H = "CAST(('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), {}, 8)) AS BIGINT)"

ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS l,
    {_H.format(1)} AS h1, {_H.format(9)} AS h2, {_H.format(17)} AS h3, {_H.format(25)} AS h4
  FROM documents),
c AS (
  SELECT doc_id, t, l, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a,
    greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
         THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT doc_id, t, n, form, array_to_string(l[1:a], '') AS pre, array_to_string(l[a + 1:b], '') AS mid,
    array_to_string(l[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
                   WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""
