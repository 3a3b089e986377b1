"""WARC archives written from pages and read back, with segmented records.

A page becomes an HTTP response in chunked transfer framing. A block over the
segment size is split: the first segment is the response record, the others are
continuation records that name it as their origin, and the last one carries the
total length. Pages with equal payloads are written once, under the smallest
id; the others become revisit records.

Reading parses the files record by record, groups continuation records by their
origin, orders them by segment number, checks that no number is missing and
that the total length fits, and takes the chunked framing off again. Revisits
get the payload of the record they refer to.

A null payload is empty. A null id sorts after every other id when the keeper of
a payload is chosen. Rows that repeat id and payload are pages of their own,
none of them a revisit of the other. A null address leaves the header out.
Extra columns are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import staged

# Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
DATE = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """A record that does not hold what its headers promise."""


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: four digits from every twenty bits."""
    digits = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(F.sha1(payload), i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digit = F.shiftright(bits, shift).bitwiseAND(31)
            digits.append(F.substring(F.lit(BASE32), digit + 1, F.lit(1)))
    return F.concat(*digits)


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in HTTP chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i : i + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The payload behind chunked transfer framing; extensions and trailers are dropped."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise WarcError("chunked framing breaks off")
        size = int(framed[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        piece = framed[end + 2 : end + 2 + size]
        if len(piece) < size or framed[end + 2 + size : end + 4 + size] != b"\r\n":
            raise WarcError("a chunk is shorter than its size")
        parts.append(piece)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("no end of the HTTP headers")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def page_id(page: int | None, digest: str, *parts: object) -> str:
    """Id of a record: page and payload, and what tells the record from others of them."""
    return f"<urn:page:{':'.join(map(str, ['' if page is None else page, digest, *parts]))}>"


def _record(headers: dict[str, object], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block


def records(
    page: int | None,
    url: str | None,
    payload: bytes | None,
    digest: str,
    owner: int | None,
    number: str,
    segment_bytes: int,
    chunk_bytes: int,
) -> Iterator[bytes]:
    """The records of one page; no payload makes a revisit of ``owner``."""
    own = page_id(page, digest, number)
    common = {
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=%~"),
    }
    payload_digest = {"WARC-Payload-Digest": f"sha1:{digest}"}
    http = {"Content-Type": "application/http;msgtype=response"}
    if payload is None:
        refers = {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": page_id(owner, digest)}
        kind = {"WARC-Type": "revisit", "WARC-Record-ID": own}
        yield _record(kind | common | refers | payload_digest | http, HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    first = {"WARC-Type": "response", "WARC-Record-ID": own} | common | payload_digest | http
    if len(block) <= segment_bytes:
        yield _record(first, block)
        return
    starts = range(0, len(block), segment_bytes)
    for segment, start in enumerate(starts, 1):
        headers = first | {"WARC-Segment-Number": 1}
        if segment > 1:
            headers = {
                "WARC-Type": "continuation",
                "WARC-Record-ID": page_id(page, digest, number, segment),
                "WARC-Segment-Origin-ID": own,
                "WARC-Segment-Number": segment,
            } | common
        if segment == len(starts):
            headers["WARC-Segment-Total-Length"] = len(block)
        yield _record(headers, block[start : start + segment_bytes])


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    segment_bytes: int = 16_384,
    chunk_bytes: int = 4096,
    records_per_file: int = 20_000,
) -> None:
    """Write gzipped archives below ``path``."""
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    source = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    )
    digests = staged(
        source.select(
            "id", base32_sha1(F.col("payload")).alias("digest"), F.length("payload").alias("size")
        ),
        "payload-digests",
    )
    # stored, so that adaptive execution may split the pages of a frequent payload
    owners = staged(
        digests.where(F.col("size") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "owners",
    )
    revisits = digests.join(owners, "digest").where(~F.col("id").eqNullSafe(F.col("owner")))
    revisits = staged(revisits.select("id", "digest", "owner").distinct(), "revisits")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, written = TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                blobs = []
                for r in batch.slice(begin, 500).to_pylist():
                    written += 1
                    page = (r["id"], r["url"], r["payload"], r["digest"], r["owner"])
                    blobs += records(*page, f"{task}-{written}", segment_bytes, chunk_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary())], names=["record"])

    named = source.withColumn("digest", base32_sha1(F.col("payload")))
    marked = (
        named.alias("p")
        .join(
            revisits.alias("r"),
            F.col("p.id").eqNullSafe(F.col("r.id")) & (F.col("p.digest") == F.col("r.digest")),
            "left",
        )
        .select(
            "p.id",
            "p.url",
            "p.digest",
            "r.owner",
            F.when(F.col("r.digest").isNull(), F.col("p.payload")).alias("payload"),
        )
    )
    (
        marked.mapInArrow(build, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, with names in lower case, and block of every record of one file."""
    packed = archive[:2] == b"\x1f\x8b"
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(archive))) if packed else io.BytesIO(archive)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise WarcError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise WarcError(f"{headers.get('warc-record-id')} breaks off")
        yield headers, block


def _verified(payload: bytes, digest: str | None, identifier: str) -> bytes:
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest and digest.removeprefix("sha1:") != own:
        raise WarcError(f"{identifier} has another payload than its digest says")
    return payload


def reassemble(identifier: str, digest: str | None, segments: list[dict]) -> bytes:
    """The payload of a segmented record. Segments that were read twice count once."""
    by_number = {s["number"]: s for s in segments}
    ordered = [by_number[n] for n in sorted(by_number)]
    if [s["number"] for s in ordered] != list(range(1, len(ordered) + 1)):
        raise WarcError(f"{identifier} lacks a segment")
    block = b"".join(s["block"] for s in ordered)
    if ordered[-1]["total"] != len(block):
        raise WarcError(f"{identifier} has {len(block)} bytes, not {ordered[-1]['total']}")
    return _verified(payload_of(block), digest, identifier)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload, payload_bytes, payload_digest) per page.

    ``refers_to`` is the page whose record a revisit refers to. A revisit has no
    payload of its own; length and digest are those of that record.
    """
    raw_schema = (
        "record_id string, type string, digest string, refers string, payload binary,"
        " number int, total long, block binary"
    )
    raw_arrow = pa.schema(
        [
            *[(n, pa.string()) for n in ("record_id", "type", "digest", "refers")],
            ("payload", pa.binary()),
            ("number", pa.int32()),
            ("total", pa.int64()),
            ("block", pa.binary()),
        ]
    )

    def raw(headers: dict[str, str], block: bytes) -> dict:
        own, kind = headers["warc-record-id"], headers["warc-type"]
        number, digest = headers.get("warc-segment-number"), headers.get("warc-payload-digest")
        row = {"record_id": headers.get("warc-segment-origin-id", own), "type": kind}
        row |= {"digest": digest, "refers": headers.get("warc-refers-to")}
        if number is not None:
            total = headers.get("warc-segment-total-length")
            return row | {"number": int(number), "total": total and int(total), "block": block}
        if kind == "response":
            return row | {"payload": _verified(payload_of(block), digest, own)}
        return row

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows = []
                for headers, block in parse(archive.as_py()):
                    rows.append(raw(headers, block))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=raw_arrow)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=raw_arrow)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole = reassemble(row["record_id"], row["digest"], row["segments"])
                yield pa.RecordBatch.from_pylist(
                    [{"record_id": row["record_id"], "payload": whole}],
                    schema=pa.schema([("record_id", pa.string()), ("payload", pa.binary())]),
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    found = staged(files.select("content").mapInArrow(read, raw_schema), "records")
    whole = found.where("type = 'response' AND number IS NULL").select("record_id", "payload")
    segments = (
        found.where("number IS NOT NULL")
        .groupBy("record_id")
        .agg(
            F.first("digest", ignorenulls=True).alias("digest"),
            F.collect_list(F.struct("number", "total", "block")).alias("segments"),
        )
        .mapInArrow(put_together, "record_id string, payload binary")
    )
    named = F.split(F.regexp_replace("record_id", ">$", ""), ":")
    responses = whole.unionByName(segments).select(
        F.nullif(named[2], F.lit("")).cast("long").alias("page_id"),
        F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
        "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        named[3].alias("named_digest"),
    )
    # one row per page and payload; repeated rows hold the same
    sizes = staged(
        responses.groupBy(F.col("page_id").alias("refers_to"), "named_digest").agg(
            F.first("payload_bytes").alias("payload_bytes"),
            F.first("payload_digest").alias("payload_digest"),
        ),
        "sizes",
    )
    referred = F.split(F.regexp_replace("refers", ">$", ""), ":")
    revisits = found.where("type = 'revisit'").select(
        F.nullif(named[2], F.lit("")).cast("long").alias("page_id"),
        F.lit("revisit").alias("record_type"),
        F.nullif(referred[2], F.lit("")).cast("long").alias("refers_to"),
        F.lit(None).cast("binary").alias("payload"),
        referred[3].alias("named_digest"),
    )
    return responses.drop("named_digest").unionByName(
        revisits.join(sizes, ["refers_to", "named_digest"], "left").drop("named_digest")
    )
