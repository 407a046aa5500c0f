"""WARC archives: pages written as segmented, chunked records, and read back whole.

Writing: a page's HTTP response uses chunked transfer framing. A block longer than a segment is
split: the first record keeps the page's type with ``WARC-Segment-Number: 1``, continuation records
carry the origin's identifier and their number, and the last one the total length. Of equal payloads
only the one with the least page_id is stored; the others are revisit records.

Spark's writer ends each record with the blank lines that the format asks for, and commits whole
files, so a lost executor leaves no partial archive. Reading follows Content-Length, so payloads may
hold anything. Records of one segment are decoded where they are read; the others are grouped by
origin identifier, which brings together the segments of one page only.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideweave.llm.common import bound_batches, scratch, trim
from tideweave.llm.exact_dedup import compact, hit_filter, memtables, sha256_hex, with_hit

#: Payloads below this are never revisits.
MIN_REVISIT = 100
SEGMENT = 32 << 10
CHUNK = 8 << 10
RECORDS_PER_FILE = 4096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

RECORD = "origin string, segment int, total long, record_type string, page_id long, refers_to long, digest string, last boolean, block binary"
PAGE = "page_id long, record_type string, refers_to long, stated_digest string, payload_bytes long, payload binary, error string"


def chunked(payload: bytes, chunk: int = CHUNK) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), chunk):
        part = payload[at : at + chunk]
        parts.append(b"%x\r\n%b\r\n" % (len(part), part))
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk without its end")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the blank lines after it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The record or records of one page."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    # Control characters and spaces can't stand in a header.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or f"urn:page:{page_id}"
    own = [("WARC-Date", DATE), ("WARC-Target-URI", target), ("X-Page-Id", page_id), ("WARC-Payload-Digest", f"sha256:{digest}")]
    kind = [("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        more = [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", refers_to)]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *own, *more, *kind], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[at : at + segment] for at in range(0, len(block), segment)]
    first = [("WARC-Segment-Number", 1)] if len(parts) > 1 else []
    yield _record([("WARC-Type", "response"), ("WARC-Record-ID", name), *own, *first, *kind], parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n)]
        if n == len(parts):
            more.append(("WARC-Segment-Total-Length", len(block)))
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), *more], part)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(CRLF + CRLF, at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        at = end + 4 + int(fields["Content-Length"])
        yield fields, data[end + 4 : at]
        at += 4


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Write one record, or its segments, for each row of ``pages`` (page_id, url, html) under ``path``.

    Null html is an empty payload; a null url is replaced by one made of the id. Rows that repeat a
    page_id and payload are all responses if they hold the least id. Other columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64).to_pylist()
                out = [r for x in rows for r in records(x["page_id"], x["url"], (x["html"] or "").encode(), x["digest"], x["refers_to"], segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    bound_batches(pages)
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", sha256_hex(payload).alias("digest"))
    long = rows.where(F.octet_length(payload) >= MIN_REVISIT)
    index = compact(memtables(long.select("digest", F.col("page_id").alias("ident"))))
    hit = with_hit(rows, hit_filter(index)).withColumn("hit", F.col("hit") & (F.octet_length(payload) >= MIN_REVISIT))
    repeated = index.where("copies > 1").select("digest", F.col("ident").alias("least"))
    refers = F.when(F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    told = hit.where("hit").join(repeated, "digest", "left").withColumn("refers_to", refers)
    alone = hit.where(~F.col("hit")).withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "url", "html", "digest", "refers_to"]
    (
        alone.select(*columns)
        .unionByName(told.select(*columns))
        .mapInArrow(encode, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path, lineSep="\r\n\r\n")
    )


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _page(block: bytes, kind: str, page_id: int | None, refers_to: int | None, digest: str, error: str | None) -> tuple:
    """One row of a whole block."""
    payload, size = None, None
    if not error:
        try:
            head, body = block.split(CRLF + CRLF, 1)
            if kind == "revisit":
                size = int(re.search(rb"(?im)^content-length: *(\d+)", head)[1])
            else:
                payload = unchunked(body) if re.search(rb"(?im)^transfer-encoding: *chunked", head) else body
                size = len(payload)
                if hashlib.sha256(payload).hexdigest() != digest:
                    error = "payload differs from its digest"
        except (ValueError, TypeError):
            error = "broken framing"
    return page_id, kind, refers_to, digest, size, payload, error


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_RECORD = pa.schema(
    [("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64())]
    + [("refers_to", pa.int64()), ("digest", pa.string()), ("last", pa.bool_()), ("block", pa.binary())]
)
_PAGE = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("stated_digest", pa.string())]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
)


def _segments(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Of all archives, the pages of one record (``whole``) or the segments of the others."""
    trim()
    for batch in batches:
        for content in batch.column("content"):
            out, size = [], 0
            for f, block in parse(content.as_buffer().to_pybytes()):
                number = _number(f.get("WARC-Segment-Number"))
                if whole != (number is None):
                    continue
                kind, digest = f["WARC-Type"], f.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                page, refers = _number(f.get("X-Page-Id")), _number(f.get("X-Refers-To-Page-Id"))
                if whole:
                    out.append(_page(block, kind, page, refers, digest, None))
                else:
                    total = _number(f.get("WARC-Segment-Total-Length"))
                    origin = f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"])
                    out.append((origin, number, total, kind, page, refers, digest, total is not None, block))
                size += len(block)
                if size > 4 << 20:
                    yield _batch(out, _PAGE if whole else _RECORD)
                    out, size = [], 0
            if out:
                yield _batch(out, _PAGE if whole else _RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives under ``path``: page_id, record_type, refers_to, stated_digest,
    payload_bytes, payload (null for revisits), error.

    ``error`` says why a page has no payload: a segment is missing or repeated, the total length
    differs, the framing is broken, or the digest differs. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    single = files.mapInArrow(lambda b: _segments(b, True), PAGE)
    parts = files.mapInArrow(lambda b: _segments(b, False), RECORD)
    joined = parts.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "total", "block"))).alias("segments"),
        *(F.max_by(c, F.col("record_type") == "response").alias(c) for c in ("record_type", "page_id", "refers_to", "digest")),
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                found = row["segments"]
                block = b"".join(s["block"] for s in found)
                error = None
                if [s["segment"] for s in found] != list(range(1, len(found) + 1)) or row["record_type"] != "response":
                    error = "segments missing or repeated"
                elif found[-1]["total"] != len(block):
                    error = "total length differs"
                yield _batch([_page(block, row["record_type"], row["page_id"], row["refers_to"], row["digest"], error)], _PAGE)

    return single.unionByName(joined.mapInArrow(assemble, PAGE))


def archive_round_trip(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back.

    Digests and lengths are taken from the payloads as read; a revisit has those its record states.
    """
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, segment)
    read = read_archives(pages.sparkSession, path)
    digest = F.when(F.col("payload").isNull(), F.col("stated_digest")).otherwise(F.sha2("payload", 256))
    return read.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", "error")
