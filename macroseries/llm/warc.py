"""WARC archives: write, index first, then read selected records by coalesced byte ranges.

Every record is a gzip member of its own, as WARC readers expect, so one can be read without the
others. Members go through Spark's text writer, with an empty gzip member as its line separator, so
archives have the same commit protocol and file systems as any Spark output and a lost executor leaves
no half archive. The index (offset and length of the stored record, URL, digest) is made by walking an
archive: members are inflated piece by piece and only their headers kept; in an archive that
isn't compressed payloads are skipped. Reads sort the selected records by file and offset, fetch
neighbours with one byte range and inflate only the records asked for. Index and reads open archives
through ``pyarrow.fs`` (local or shared disks, hdfs, s3).
"""

from __future__ import annotations

import gzip
import re
import zlib
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from macroseries.llm.common import write_once

END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_GAP, MAX_READ = 64 << 10, 8 << 20
SPLIT = 64 << 20
HEAD_READ, PIECE = 1 << 20, 32 << 10
GZIP = b"\x1f\x8b"
LEVEL = 6
SEPARATOR = gzip.compress(b"", mtime=0)
#: repeated digests up to this number are broadcast to the pages (about 100 bytes each)
BROADCAST_ROWS = 1_000_000
# payload_offset counts from the start of the record as written, before compression
INDEX = ("path string, offset bigint, length bigint, payload_offset bigint, payload_length bigint, "
         "page_id bigint, url string, digest string, record_type string, refers_to bigint")


def base32_sha1(data: Column) -> Column:
    """Base-32 SHA-1 of a binary column: 40 hex digits, ten at a time, are eight base-32 digits."""
    h = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(h, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(*lines: Column) -> Column:
    return F.concat_ws("\r\n", *lines)


def _named(name: str, value: Column) -> Column:
    """``name: value``, or NULL (left out) for a NULL value."""
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


@F.pandas_udf(BinaryType())
def _member(record: pd.Series) -> pd.Series:
    """Each record as a gzip member."""
    return record.map(lambda r: gzip.compress(r, LEVEL, mtime=0))


def records(pages: DataFrame, min_bytes: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of every row of ``pages``
    (page_id, url, html). Among equal payloads of at least ``min_bytes``, the largest page_id is the
    response and the others revisit it. NULL html is an empty payload; rows that tie on the largest
    page_id, and equal payloads without any page_id, are all responses.

    Digests that repeat are written once and counted: up to ``broadcast_rows`` of them are sent to the
    pages, so that no payload moves; beyond, pages are joined to them by digest."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    base = base.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8")))
    first = (base.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1 AND first IS NOT NULL").select("digest", "first"))
    first = write_once(first, "repeated-digests")
    few = first.count() <= broadcast_rows
    first = F.broadcast(first) if few else first.hint("merge")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return base.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write a WARC/1.1 record per row of ``pages`` below ``path``, one archive per partition and one
    gzip member per record. A revisit carries headers only. Control characters, spaces and ``%`` of a URL are percent-encoded
    in its header; a NULL URL or page_id leaves its header out."""
    r = records(pages, min_bytes)
    response = F.col("record_type") == "response"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.lit("Content-Length: "), F.octet_length("payload").cast("string"),
                    F.lit(END))
    size = F.octet_length(http) + F.when(response, F.octet_length("payload")).otherwise(0)
    url = F.col("url")
    for c in ["%", *map(chr, range(33)), "\x7f"]:
        url = F.replace(url, F.lit(c), F.lit(f"%{ord(c):02X}"))
    head = _header(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"),
        _named("WARC-Record-ID", _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"), _named("WARC-Target-URI", url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        _named("WARC-Refers-To", _record_id(F.col("refers_to"))),
        F.when(~response, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), size.cast("string")))
    body = F.when(response, F.col("payload")).otherwise(F.lit(""))
    record = F.encode(F.concat(head, F.lit(END), http, body, F.lit(END)), "UTF-8")
    (r.select(_member(record).cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1"))
     .text(path))


def _open(path: str):
    from pyarrow import fs
    uri = re.sub(r"^file:/*", "file:///", re.sub(r"^s3[an]:", "s3:", path))
    if uri.startswith("file:///"):
        return fs.LocalFileSystem().open_input_file(uri[len("file://"):])
    store, name = fs.FileSystem.from_uri(uri)
    return store.open_input_file(name)


_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def _page(value: str | None) -> int | None:
    m = _PAGE.fullmatch(value or "")
    return int(m[1]) if m else None


def _entry(path: str, offset: int, length: int, head: bytes, payload: int, size: int) -> tuple:
    """Index row of the record whose header is ``head`` and whose ``size`` bytes hold its payload from
    ``payload`` on."""
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    url = fields.get("WARC-Target-URI")
    return (path, offset, length, payload, size - payload, _page(fields.get("WARC-Record-ID")),
            None if url is None else unquote(url),
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"],
            _page(fields.get("WARC-Refers-To")))


def _content_length(head: bytes) -> int:
    return int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])


def _walk(path: str, size: int):
    """Index rows of one archive, in order."""
    if size == 0:
        return
    with _open(path) as f:
        packed = f.read_at(2, 0) == GZIP
        yield from (_walk_members if packed else _walk_plain)(f, path, size)


def _walk_plain(f, path: str, size: int):
    """An archive that isn't compressed: headers are parsed from a sliding buffer; the walk jumps over
    what ``Content-Length`` covers."""
    at, base, buf = 0, 0, b""

    def need(start: int, mark: bytes) -> int:
        """Position after ``mark`` at or after ``start``; reads on until it is there."""
        nonlocal base, buf
        more = HEAD_READ
        while True:
            if start >= base:
                k = buf.find(mark, start - base)
                if k >= 0:
                    return base + k + len(mark)
            if base + len(buf) >= size and base <= start:
                raise ValueError(f"{path}: record at {at} has no header end")
            base, buf = start, f.read_at(more, start)
            more *= 2

    while at < size:
        body = need(at, b"\r\n\r\n")
        head = buf[at - base:body - base]
        length = body - at + _content_length(head)
        yield _entry(path, at, length, head, need(body, b"\r\n\r\n") - at, length)
        at += length + len(END)


def _walk_members(f, path: str, size: int):
    """An archive of gzip members, inflated in pieces of ``PIECE`` bytes, of which only those up to the
    end of both headers are kept. Members without a record are passed over."""
    base, block = 0, b""
    at = start = 0
    while at < size:
        start, inflate, head, marks = at, zlib.decompressobj(31), b"", []
        while not inflate.eof:
            if at >= base + len(block):
                base, block = at, f.read_at(HEAD_READ, at)
            data = block[at - base:at - base + PIECE]
            piece = inflate.decompress(data, PIECE)
            at += len(data) - len(inflate.unused_data if inflate.eof else inflate.unconsumed_tail)
            if not (data or piece or inflate.eof):
                raise ValueError(f"{path}: the member at {start} has no end")
            if len(marks) < 2:
                head += piece
                while len(marks) < 2 and (k := head.find(END.encode(), marks[0] if marks else 0)) >= 0:
                    marks.append(k + len(END))
        if len(marks) == 2:
            total = marks[0] + _content_length(head[:marks[0]])
            yield _entry(path, start, at - start, head[:marks[0]], marks[1], total)
        elif head.strip():
            raise ValueError(f"{path}: the record at {start} has no header end")


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: path, offset, length, payload_offset,
    payload_length, page_id, url, digest, record_type, refers_to."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")

    def run(batches):
        for b in batches:
            for p, n in zip(b["path"], b["length"]):
                rows = []
                for row in _walk(p, int(n)):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)
    return files.mapInPandas(run, INDEX)


def _frame(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")]).astype(
        {"page_id": "Int64", "refers_to": "Int64"})


def read_records(selected: DataFrame, max_gap: int = MAX_GAP, max_read: int = MAX_READ) -> DataFrame:
    """The ``payload`` (binary) of each selected index row, next to page_id, url and digest.
    Records are sorted by file and offset; neighbours at most ``max_gap`` bytes apart are fetched by
    one read of at most ``max_read`` bytes (or one record) and handed on about ``max_read`` bytes of
    payload (or one) at a time."""
    part = F.floor(F.col("offset") / SPLIT)
    rows = selected.repartition("path", part).sortWithinPartitions("path", "offset")
    rows = rows.select("path", "offset", "length", "payload_offset", "payload_length", "page_id",
                       "url", "digest")

    def payload(record: bytes, at: int, n: int) -> bytes:
        if record[:2] == GZIP:
            record = zlib.decompress(record, 31)
        return record[at:at + n]

    def run(batches):
        for b in batches:
            start = 0
            first = b["offset"].tolist()
            last = (b["offset"] + b["length"]).tolist()
            paths = b["path"].tolist()
            inside, sizes = b["payload_offset"].tolist(), b["payload_length"].tolist()
            for k in range(1, len(b) + 1):
                if k < len(b) and paths[k] == paths[start] and (
                        first[k] - last[k - 1] <= max_gap and last[k] - first[start] <= max_read):
                    continue
                with _open(paths[start]) as f:
                    data = memoryview(f.read_at(last[k - 1] - first[start], first[start]))
                off = first[start]
                while start < k:
                    end, room = start, max_read
                    while end < k and (end == start or sizes[end] <= room):
                        room -= sizes[end]
                        end += 1
                    got = b.iloc[start:end]
                    yield pd.DataFrame({
                        "page_id": got["page_id"].astype("Int64"), "url": got["url"],
                        "digest": got["digest"],
                        "payload": [payload(bytes(data[first[i] - off:last[i] - off]), inside[i],
                                            sizes[i]) for i in range(start, end)]})
                    start = end
    return rows.mapInPandas(run, "page_id bigint, url string, digest string, payload binary")


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the archives below ``path``: page_id, payload_bytes, payload_digest (both of
    the full payload as read, a revisit's from its response), record_type, refers_to, url."""
    idx = write_once(index(spark, path), "warc-index")
    got = read_records(idx.filter("record_type = 'response'"))
    got = write_once(got.select("page_id", "url", "digest",
                                F.octet_length("payload").cast("long").alias("payload_bytes"),
                                base32_sha1(F.col("payload")).alias("payload_digest")), "payloads")
    full = got.groupBy(F.col("page_id").alias("refers_to"), "digest").agg(
        F.first("payload_bytes").alias("payload_bytes"),
        F.first("payload_digest").alias("payload_digest"))
    again = idx.filter("record_type = 'revisit'").join(full, ["refers_to", "digest"], "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return got.select("page_id", "payload_bytes", "payload_digest",
                      F.lit("response").alias("record_type"),
                      F.lit(None).cast("long").alias("refers_to"), "url").unionByName(
        again.select(*cols))
