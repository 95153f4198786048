"""WARC archives with a Zstandard dictionary per file.

A task holds back the records of one file (``FILE_BYTES`` of payload), builds
a dictionary from pieces spread over all of them, and writes the file: the
dictionary in a leading skippable frame, then every record as a frame of its
own. Records with equal long payloads are stored once; the others are
revisits, which carry the headers only.

Files lie in the shared folder, under names that no other attempt of a task
uses. Only files in the manifest, which Spark commits, count, so an executor
lost half-way leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import batches_of, rows_of, work_dir, written

FILE_BYTES = 32 << 20       # payload bytes of a file
READ_TASKS = 100_000        # tasks that read archives back; a file each, up to this number
MIN_REVISIT = 1_000         # shorter payloads are stored every time
DICT_BYTES = 64 << 10       # size of a dictionary
SAMPLE_BYTES = 4 << 20      # bytes that a dictionary is built from
SAMPLE_PIECE = 8 << 10      # bytes taken from a place
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
SKIPPABLE = 0x184D2A5D      # magic number of the dictionary frame; fixed value
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(value: str | None) -> str:
    """Header values hold no line ends or other control characters."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value or "")


def record(page_id: int | None, url: str | None, payload: str | None, length: int, sha1: str, keep: int | None,
           date: str = DATE) -> bytes:
    """One WARC record; without a payload it is a revisit of page ``keep``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    kind = "revisit" if payload is None else "response"
    block = http + (payload or "").encode("utf-8", "surrogatepass")
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
             f"WARC-Date: {date}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{keep}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes | None:
    """A dictionary from evenly spread pieces of the records; None if they are too few."""
    total = sum(map(len, records))
    every = max(1, total // SAMPLE_BYTES)
    pieces = [r[at:at + SAMPLE_PIECE] for k, r in enumerate(records)
              for at in range((k % every) * SAMPLE_PIECE, max(len(r), 1), every * SAMPLE_PIECE)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, [p for p in pieces if len(p) >= 8], k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return None


def write_file(path: str, records: list[bytes]) -> tuple[int, int]:
    """Write a file; its size and its dictionary's."""
    dictionary = build_dictionary(records)
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, dict_data=dictionary and zstandard.ZstdCompressionDict(dictionary))
    store, name = fs.FileSystem.from_uri(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        size = 0
        if dictionary:
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
            size += out.write(struct.pack("<II", SKIPPABLE, len(frame)) + frame)
        for r in records:
            size += out.write(compressor.compress(r))
    return size, len(dictionary or b"")


def read_file(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, in order; memory holds one record."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as source:
        start = source.read(8)
        dictionary, ahead = None, start
        if len(start) == 8 and struct.unpack("<I", start[:4])[0] == SKIPPABLE:
            packed = source.read(struct.unpack("<I", start[4:])[0])
            dictionary, ahead = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(packed)), b""
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(_Joined(ahead, source), read_across_frames=True)
        buffer = bytearray()

        def fill(need: int) -> bool:
            while len(buffer) < need:
                more = reader.read(max(1 << 16, need - len(buffer)))
                if not more:
                    return False
                buffer.extend(more)
            return True

        while fill(1):
            end = buffer.find(b"\r\n\r\n")
            while end < 0:
                if not fill(len(buffer) + 1):
                    raise ValueError(f"{path}: a record's header is cut off")
                end = buffer.find(b"\r\n\r\n")
            head = dict(line.split(": ", 1) for line in buffer[:end].decode().split("\r\n")[1:])
            stop = end + 4 + int(head["Content-Length"])
            if not fill(stop + 4):
                raise ValueError(f"{path}: a record is cut off")
            yield head, bytes(buffer[end + 4:stop])
            del buffer[:stop + 4]


class _Joined:
    """Bytes already read, then the rest of a stream."""

    def __init__(self, ahead: bytes, source):
        self.ahead, self.source = ahead, source

    def read(self, size: int = -1) -> bytes:
        if self.ahead:
            out, self.ahead = self.ahead, b""
            return out
        return self.source.read(size)


MANIFEST_SCHEMA = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("dictionary_bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archive every row of ``pages`` (page_id, url, html); the manifest of the files.

    Null html is an empty payload. Of equal payloads of ``MIN_REVISIT`` bytes
    or more the row with the largest page_id is the response, and so is every
    repeated row with that id; the others, rows without an id too, revisit it.
    If no row of a group has an id, all are responses."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"),
                        F.octet_length(html).cast("bigint").alias("length"), F.sha1(html.cast("binary")).alias("sha1"),
                        F.sha2(html.cast("binary"), 256).alias("sha256"))
    groups = rows.filter(F.col("length") >= MIN_REVISIT).groupBy("sha256").agg(
        F.max("page_id").alias("keep"), F.count("*").alias("n")).filter("n > 1 AND keep IS NOT NULL").drop("n")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    told = rows.join(groups, "sha256", "left").select(
        "page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "length", "sha1", "keep")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple]:
            held: list[bytes] = []
            size = 0
            for row in rows_of(batches, "page_id", "url", "html", "length", "sha1", "keep"):
                held.append(record(*row))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield closed(held)
                    held, size = [], 0
            if held:
                yield closed(held)

        def closed(held: list[bytes]) -> tuple:
            path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            return (path, len(held), *write_file(path, held))

        yield from batches_of(files(), MANIFEST_SCHEMA, 1)

    return written(told.mapInArrow(write, "file string, records bigint, bytes bigint, dictionary_bytes bigint"), "manifest")


PAGE_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                         ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
PAGE_DDL = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
            "url string, payload binary")


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """One row per record of the manifest's files. Payloads of responses are
    held against their digest; a revisit has none, its length and digest are
    those in its headers. An empty manifest gives an empty result."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (file,) in rows_of(batches, "file"):
                for head, block in read_file(file):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    sha1 = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    kind = head["WARC-Type"]
                    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != sha1):
                        raise ValueError(f"{file}: {head['WARC-Record-ID']} does not match its digest")
                    yield (_page(head["WARC-Record-ID"]), length, sha1, kind,
                           _page(head["WARC-Refers-To"]) if kind == "revisit" else None, head["WARC-Target-URI"],
                           payload if keep_payload and kind == "response" else None)

        yield from batches_of(rows(), PAGE_SCHEMA, 256)

    # A stated number, so that the few rows of a manifest aren't put together into one task.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    return manifest.select("file").repartition(tasks).mapInArrow(read, PAGE_DDL)


def op1_warc(pages: DataFrame) -> DataFrame:
    """The query's rows: archive a ``pages`` table, then read the archives back."""
    manifest = write_archives(pages, work_dir(pages.sparkSession, "warc"))
    return read_archives(manifest, keep_payload=False).drop("url", "payload")


ORACLE = """
WITH r AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS keep FROM r)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM d
"""
