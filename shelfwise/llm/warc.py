"""WARC archives: a writer with deduplicated payloads, and a splittable reader.

The writer makes one gzip member of each record. Tasks write files of their own, under names that no other attempt uses; only
files that a finished task has reported count, so a repeated task leaves an unread file and no repeated record.

The reader cuts files into byte ranges. A task looks for the gzip magic in its range, takes a place for a member only if it
decodes to a WARC header whose length agrees, and owns the records that start inside, reading past the end of the range where
the last one goes on. From a found member the next one follows directly, so bytes inside a member are never searched.
A member may hold several records. Files are opened through ``pyarrow.fs``, which reads local, HDFS and object-store paths.

Defined cases: a null payload is empty; a null url has no target; a null page id is written as such and comes last among equal
payloads; rows that repeat the smallest page id of a payload are all responses; no rows give no files and no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import stored
from shelfwise.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
READ = 1 << 18
DATE = "2000-01-01T00:00:00Z"
RECORDS = "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, " \
          "payload binary, payload_bytes long, payload_digest string"


def _open(path: str, write: bool = False):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if write:
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        return store.open_output_stream(name, compression=None)  # the records are compressed already
    return store.open_input_file(name)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, record_id: str, url: str | None, payload: bytes, digest: str, size: int, refers: str | None = None) -> bytes:
    """One record, compressed as a member of its own."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = head if kind == "revisit" else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers}>"]
    lines.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(4, wbits=31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _urn(page_id) -> str:
    return "urn:page:" + ("null" if pd.isna(page_id) else str(int(page_id)))


def write(pages: DataFrame, folder: str, file_bytes: int = 1 << 28, revisit_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) under ``folder``; returns the files as (path, bytes).

    Of records with equal payloads of at least ``revisit_bytes`` bytes all but the one with the smallest page id are revisits.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    same = own.where(F.octet_length("html") >= revisit_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first")
    rows = own.join(same, "sha", "left").select("page_id", "url", "html", "first", (
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("again"))

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = path = None
        for pdf in batches:
            for page_id, url, html, first, again in zip(pdf.page_id, pdf.url, pdf.html, pdf["first"], pdf.again):
                if out is None:
                    path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
                    out = _open(path, write=True)
                data = html.encode("utf-8")
                out.write(record("revisit" if again else "response", _urn(page_id), url, data, _digest(data), len(data),
                                 _urn(first) if again else None))
                if out.tell() >= file_bytes:
                    size = out.tell()
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [path], "bytes": [size]})
        if out is not None:
            size = out.tell()
            out.close()
            yield pd.DataFrame({"path": [path], "bytes": [size]})

    return stored(rows.mapInPandas(save, "path string, bytes long"), "warc-files")[0]


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (x.split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _member(file, at: int, size: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at ``at`` and its end; None if no whole member with a WARC header is there."""
    z, out, pos = zlib.decompressobj(wbits=31), [], at
    file.seek(at)
    try:
        while not z.eof:
            data = file.read(READ)
            if not data:
                return None
            pos += len(data)
            out.append(z.decompress(data))
            if len(out) == 1 and not out[0].startswith(b"WARC/1.") and len(out[0]) >= 7:
                return None
    except zlib.error:
        return None
    whole = b"".join(out)
    return (whole, pos - len(z.unused_data)) if whole.startswith(b"WARC/1.") else None


def _records(whole: bytes) -> list[tuple[dict[bytes, bytes], bytes]] | None:
    """The records of a member; None unless every length agrees."""
    found, at = [], 0
    while at < len(whole):
        end = whole.find(b"\r\n\r\n", at)
        head = _fields(whole[at:end]) if end >= 0 and whole.startswith(b"WARC/1.", at) else {}
        length = head.get(b"content-length", b"")
        if not length.isdigit() or whole[end + 4 + int(length):end + 8 + int(length)] != b"\r\n\r\n":
            return None
        found.append((head, whole[end + 4:end + 4 + int(length)]))
        at = end + 8 + int(length)
    return found


def range_members(file, start: int, end: int, size: int) -> Iterator[tuple[int, list]]:
    """(offset, records) of the members that start in [start, end) of an open file."""
    at, follow = start, False
    while at < end:
        if not follow:
            file.seek(at)
            data = file.read(min(READ, end - at) + len(MAGIC) - 1)
            hit = data.find(MAGIC)
            if hit < 0:
                at += max(1, len(data) - len(MAGIC) + 1)
                continue
            at += hit
            if at >= end:
                return
        member = _member(file, at, size)
        records = _records(member[0]) if member else None
        if records is None:
            at, follow = at + 1, False
            continue
        file.seek(member[1])
        after = file.read(len(MAGIC))
        if after and after != MAGIC and not follow:  # a member stored inside another one isn't followed by a member
            at += 1
            continue
        yield at, records
        at, follow = member[1], after == MAGIC


def read(files: DataFrame, range_bytes: int = 1 << 23) -> DataFrame:
    """The records of gzip WARC files (path, bytes), with HTTP payloads; digest and length are those of the full payload."""
    starts = F.explode(F.when(F.col("bytes") > 0, F.expr(f"sequence(0L, bytes - 1, {range_bytes}L)"))).alias("start")
    ranges = files.select("path", "bytes", starts).select("path", "bytes", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, size, start, end in zip(pdf.path, pdf.bytes, pdf.start, pdf.end):
                rows, held = [], 0
                with _open(path) as file:
                    for offset, records in range_members(file, start, end, size):
                        for head, block in records:
                            kind = head.get(b"warc-type", b"").decode()
                            http, _, payload = block.partition(b"\r\n\r\n")
                            digest, length = _digest(payload), len(payload)
                            if kind == "revisit":
                                digest = head.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
                                length = int(_fields(http).get(b"content-length", b"0"))
                            text = lambda k: head[k].decode().strip("<>") if k in head else None
                            rows.append((path, offset, kind, text(b"warc-record-id"), text(b"warc-target-uri"),
                                         text(b"warc-refers-to"), payload, length, digest))
                            held += len(payload)
                        if held > 1 << 23:
                            yield pd.DataFrame(rows, columns=[x.split()[0] for x in RECORDS.split(", ")])
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=[x.split()[0] for x in RECORDS.split(", ")])

    return ranges.repartition("path", "start").mapInPandas(load, RECORDS)


def page_of(urn) -> F.Column:
    """The page id in a record id; null if it has none."""
    return F.regexp_extract(urn, r"^urn:page:(-?\d+)$", 1).try_cast("long")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared scratch folder and reads the records back."""
    return read(write(pages, scratch_dir(spark, "warc")))
