"""WARC writing and a salvaging reader (operator 7).

``write_warc`` writes a WARC/1.1 record per page: an HTTP response whose
payload is the page's HTML, or, for a payload that an earlier page (smaller id) has, a
``revisit`` that refers to it. Archives are plain, or (``members``) have a gzip
member per record, each followed by an empty member, as Spark's text writer
needs a separator. ``read_warc`` reads both kinds back. A record is good if its length, its terminator
and its digest hold. After a failed check the reader searches for the next place where a
member or a version line begins and a good record follows, goes on there, and
reports the bytes passed over as a gap.

Scale: digests are grouped after a partial aggregation; the html is shuffled
once, as its response record (compressed before if ``members``), by digest and salt (``SALTS`` parts a digest), so a payload that a third
of all pages share is spread. Files are written by Spark; the reader takes a
file at a time, whose size the writer bounds (``FILE_BYTES``, at least one record).

Defined results: NULL html is an empty payload; payloads under ``MIN_REVISIT``
bytes are never revisits; pages with one id and payload are all responses if
the id is the smallest; a NULL id is never referred to; NULL urls give no
target header; empty tables give no records; an empty file has none and no gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import quoted, scratch, slices

MIN_REVISIT = 100
SALTS = 32
FILE_BYTES = 64 << 20
_END = b"\r\n\r\n"
_URN = "urn:page:"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(name + ": "), value, F.lit("\r\n")))


def _urn(page: Column) -> Column:
    return F.concat(F.lit(f"<{_URN}"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _record_text(kind: str, date: str, first: Column | None, body: Column | None) -> Column:
    """A record, but for its closing blank lines, from the columns id, url, bytes and digest."""
    block = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
                     body if body is not None else F.lit(""))
    about = [] if first is None else [_header("WARC-Profile", F.lit(_SAME)), _header("WARC-Refers-To", _urn(first))]
    return F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", F.lit(kind)), _header("WARC-Record-ID", _urn(F.col("id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.col("bytes").cast("string")), *about,
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def _member_of(record: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


_EMPTY = _member_of(b"")


@F.arrow_udf(T.BinaryType())
def _member(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for records in slices(batches, 200):
        yield pa.array([None if r is None else _member_of(r + _END) for r in records.to_pylist()], type=pa.binary())


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 date: str = "1970-01-01T00:00:00Z", members: bool = False) -> DataFrame:
    """(record): the bytes of each page's record; plain ones without their closing blank lines."""
    coded = _member if members else (lambda c: c)
    rows = pages.select(F.col(quoted(page_id)).cast("long").alias("id"), F.col(quoted(url)).cast("string").alias("url"),
                        F.coalesce(F.col(quoted(html)), F.lit("")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")) \
        .withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    shared = rows.filter(F.col("bytes") >= MIN_REVISIT).groupBy("digest") \
        .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL")
    salted = shared.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # the html goes into its record before the shuffle, which carries members compressed
    full = rows.select("id", "url", "bytes", "digest",
                       F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int").alias("salt"),
                       coded(_record_text("response", date, None, F.col("html")).cast("binary")).alias("response"))
    joined = full.join(salted, ["digest", "salt"], "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    revisit = F.when(again, _record_text("revisit", date, F.col("first"), None).cast("binary"))
    return joined.withColumn("revisit", coded(revisit)) \
        .select(F.coalesce("revisit", "response").alias("record"))


def write_warc(pages: DataFrame, out: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               file_bytes: int = FILE_BYTES, members: bool = False) -> None:
    """Write the pages' records as archive files to the folder ``out``, plain or as gzip members."""
    size = pages.agg(F.avg(F.octet_length(quoted(html))).alias("b")).first()["b"] or 0
    records = page_records(pages, page_id, url, html, members=members)
    # The text writer passes on a string's bytes as they are, and a separator in the encoding named.
    (records.select(F.col("record").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", (_EMPTY if members else _END).decode("latin-1"))
     .option("maxRecordsPerFile", max(1, int(file_bytes // (size + 600)))).text(out))


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str]
    payload: bytes


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_START = re.compile(rb"WARC/\d+\.\d+\r\n|\x1f\x8b\x08")


_STEP = 16 << 10  # bytes inflated at a time


class Broken(ValueError):
    pass


def _headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.split(b"\r\n"):
        name, sep, value = line.partition(b":")
        if not sep:
            raise Broken("header line without a colon")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _plain(data: bytes, at: int) -> Record:
    """The record at ``at``, or Broken with the failed check."""
    version = _VERSION.match(data, at)
    if not version:
        raise Broken("no version line")
    end = data.find(_END, version.end())
    if end < 0:
        raise Broken("header without end")
    headers = _headers(data[version.end():end])
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Broken("no content length")
    start = end + 4
    stop = start + int(length)
    if stop > len(data) or data[stop:stop + 4] != _END:
        raise Broken("length does not meet the record's end")
    block = data[start:stop]
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        cut = block.find(_END)
        if cut < 0:
            raise Broken("http header without end")
        payload = block[cut + 4:]
    for name, value in (("warc-block-digest", block), ("warc-payload-digest", payload)):
        kind, _, want = headers.get(name, "").partition(":")
        if name == "warc-payload-digest" and headers.get("warc-type") == "revisit":
            continue  # the digest of the payload that is referred to
        if kind in ("sha1", "sha256") and len(want) == hashlib.new(kind).digest_size * 2 \
                and hashlib.new(kind, value).hexdigest() != want.lower():
            raise Broken(f"{name} does not match")
    return Record(at, stop + 4 - at, headers, payload)


def _inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the member at ``at``, and where the member ends."""
    member, out, view = zlib.decompressobj(wbits=31), [], memoryview(data)
    stop = at
    try:
        while not member.eof:
            part = view[stop:stop + _STEP]
            if not part:
                raise Broken("member without end")
            out.append(member.decompress(part))
            stop += len(part)
    except zlib.error as e:
        raise Broken("member does not inflate") from e
    return b"".join(out), stop - len(member.unused_data)


def _record(data: bytes, at: int) -> Record | None:
    """The record at ``at``, plain or a gzip member; None at the end. Empty members are passed over."""
    begin = at
    while data.startswith(b"\x1f\x8b", at):
        inner, stop = _inflated(data, at)
        if inner:
            found = _plain(inner, 0)
            if found.length != len(inner):
                raise Broken("member holds more than a record")
            return Record(begin, stop - begin, found.headers, found.payload)
        at = stop
        if at == len(data):
            return None
    found = _plain(data, at)
    return Record(begin, found.offset + found.length - begin, found.headers, found.payload)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """The good records of an archive, in order, and the gaps between them."""
    at = 0
    while at < len(data):
        try:
            found = _record(data, at)
        except Broken as e:
            gap, reason, found = at, str(e), None
            for start in _START.finditer(data, at + 1):
                try:
                    found = _record(data, start.start())
                    break
                except Broken:
                    continue
            at = len(data) if found is None else found.offset
            yield Gap(gap, at - gap, reason)
        if found is None:
            return
        yield found
        at = found.offset + found.length


_FIELDS = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
    ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary())])
_SCHEMA = ("file string, offset long, length long, gap string, record_type string, record_id string, "
           "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary")


def _entry(file: str, x: Record | Gap, payload: bool) -> dict:
    if isinstance(x, Gap):
        return {"file": file, "offset": x.offset, "length": x.length, "gap": x.reason}
    h = x.headers
    revisit = h.get("warc-type") == "revisit"
    return {"file": file, "offset": x.offset, "length": x.length, "record_type": h.get("warc-type"),
            "record_id": h.get("warc-record-id"), "target_uri": h.get("warc-target-uri"),
            "refers_to": h.get("warc-refers-to"),
            # of the full payload: a revisit states both, a response is measured
            "payload_bytes": int(h["warc-payload-length"]) if revisit and h.get("warc-payload-length", "").isdigit()
            else len(x.payload),
            "payload_digest": h.get("warc-payload-digest", "").partition(":")[2].lower() if revisit
            else hashlib.sha256(x.payload).hexdigest(),
            "payload": x.payload if payload else None}


def read_warc(spark: SparkSession, path: str, payload: bool = True, strict: bool = False) -> DataFrame:
    """One row per record, and one per gap (``gap``: the check that failed;
    ``offset`` and ``length``: the quarantined bytes) of the archives in ``path``.
    ``strict``: a gap ends the job with an error instead, for archives that must be whole."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, data = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                part, size = [], 0
                for x in salvage(data):
                    if strict and isinstance(x, Gap):
                        raise ValueError(f"{file}: {x.length} bytes from {x.offset} on hold no record: {x.reason}")
                    part.append(_entry(file, x, payload))
                    size += x.length if payload else 200
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(part, schema=_FIELDS)
                        part, size = [], 0
                yield pa.RecordBatch.from_pylist(part, schema=_FIELDS)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, _SCHEMA)


def archive_report(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                   out: str | None = None) -> DataFrame:
    """Write the pages to archives, read them back: a row per page's record. Archives that don't read back whole fail."""
    out = out or scratch(pages.sparkSession, "warc")
    write_warc(pages, out, page_id, url, html, members=True)
    back = read_warc(pages.sparkSession, out, payload=False, strict=True)

    def number(name: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({name}, '^<{_URN}(-?[0-9]+)>$', 1) AS BIGINT)")

    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"))
