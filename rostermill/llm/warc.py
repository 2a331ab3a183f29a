"""Write web pages as WARC files and read them back.

Writing. Each page gets one record with a header of its own; a payload above
``SEGMENT`` bytes is split over a first record and continuation records that
name it as their origin. Payloads are stored as HTTP responses in chunked
transfer coding. Of pages with equal payloads of at least ``LEAST`` bytes the
one with the smallest id is a *response*, the others are *revisit* records
that refer to it and carry the HTTP head alone. Spark's text writer puts the
records into gzip files: a record's closing empty line is the writer's line
end, so a file is exactly a sequence of records, a lost task leaves nothing
behind, and any store that Spark writes to will do. A file has at most
``RECORDS`` records, which bounds what a reader holds.

Reading. Files are cut into records by their content lengths. Records are
grouped by origin, put in the order of their segment numbers, joined, checked
against the total length, taken out of the chunked coding and checked against
the digest in the header. Segments of one page meet in one group; different
pages are different groups, so a common payload is not a common group.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.llm.bpe import slices
from rostermill.workdir import staged

#: bytes of a record's block, of a chunk in it, and records of a file, at most
SEGMENT = 16_384
CHUNK = 4_096
RECORDS = 2_000
#: payloads below this are stored each time
LEAST = 100

_VERSION = b"WARC/1.1\r\n"
_DATE = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None, digest: str) -> str:
    """The record id of a page's payload, the same in every run."""
    h = hashlib.sha256(f"page {page} {digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer coding."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts.append(b"%x\r\n%s\r\n" % (len(part), part))
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        parts.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the line end that closes it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return b"".join([_VERSION, lines.encode(), b"\r\n", block, b"\r\n"])


def _uri(url: str | None) -> str:
    """A URL fit for a header line: white space and control characters encoded."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def page_records(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page."""
    name = record_id(page, digest)
    common = [("WARC-Date", _DATE), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    common += [] if page is None else [("WARC-Page-ID", page)]
    http = "Content-Type", "application/http; msgtype=response"
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        more = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Page-ID", refers_to)]
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common, *more, http], block)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, http]
    if len(block) <= segment:
        return [_record(first, block)]
    out = [_record([*first, ("WARC-Segment-Number", 1)], block[:segment])]
    for number, at in enumerate(range(segment, len(block), segment), 2):
        headers = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"{name[:-1]}-{number}>"),
            ("WARC-Date", _DATE),
            ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Number", number),
        ]
        if at + segment >= len(block):
            headers.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_record(headers, block[at : at + segment]))
    return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; names are in lower case."""
    at = 0
    while at < len(data):
        if not data.startswith(_VERSION, at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at + len(_VERSION) : end].decode().split("\r\n")
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        begin = end + 4
        stop = begin + int(headers["content-length"])
        yield headers, data[begin:stop]
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end at {stop}")
        at = stop + 4


# -- writing ------------------------------------------------------------------


def first_pages(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat an earlier payload.

    Only digests are shuffled. Payloads are grouped with the leaf partition
    they lie in first, so a payload in a third of all pages costs a row per
    partition; ``refers_to`` comes back the same way.
    """
    body = F.coalesce("html", F.lit(""))
    rows = pages.where(F.col("page_id").isNotNull() & (F.octet_length(body) >= least)).select(
        "page_id", F.unhex(F.sha2(body, 256)).alias("digest"), F.spark_partition_id().alias("leaf")
    )
    rows = staged(rows, "digests")  # a row keeps its leaf wherever it is used
    leaves = rows.groupBy("digest", "leaf").agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
    firsts = leaves.groupBy("digest").agg(F.min("first").alias("refers_to"), F.sum("pages").alias("pages")).where("pages > 1")
    known = leaves.select("digest", "leaf").join(firsts.select("digest", "refers_to"), "digest")
    return rows.join(known, ["digest", "leaf"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str, least: int = LEAST, segment: int = SEGMENT) -> None:
    """Write all pages (page_id, url, html) to gzip WARC files in ``folder``.

    Null html is an empty payload, a null URL an empty one. Every row has a
    record, also of rows that repeat an id. One without a page_id is a response
    that names no page, and none refers to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: list[bytes] = []
                for page, url, html, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    payload = (html or "").encode()
                    out += page_records(page, url, payload, hashlib.sha256(payload).hexdigest(), refers_to, segment)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    narrow = pages.select("page_id", "url", "html")
    digest = F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256))
    marked = (
        narrow.withColumn("digest", digest)
        .join(first_pages(narrow, least), ["page_id", "digest"], "left")
        .select("page_id", "url", "html", "refers_to")
    )
    records = marked.mapInArrow(run, "record binary")
    # the writer's line end is the second half of the empty line after a block
    records.selectExpr("cast(record AS string) AS value").write.option("lineSep", "\r\n").option(
        "maxRecordsPerFile", RECORDS
    ).option("compression", "gzip").text(folder)


# -- reading ------------------------------------------------------------------

_SEGMENTS = "origin string, number long, total long, type string, page_id long, refers_to long, digest string, block binary"


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files, by origin and segment number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in parse(zlib.decompress(content.as_buffer(), wbits=47)):
                    whole = "warc-segment-number" not in h
                    rows.append(
                        (
                            h.get("warc-segment-origin-id", h["warc-record-id"]),
                            int(h.get("warc-segment-number", 1)),
                            len(block) if whole else _number(h.get("warc-segment-total-length")),
                            h["warc-type"],
                            _number(h.get("warc-page-id")),
                            _number(h.get("warc-refers-to-page-id")),
                            h.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                            block,
                        )
                    )
                names = [f.split()[0] for f in _SEGMENTS.split(", ")]
                kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
                arrays = [pa.array(c, kinds[f.split()[1]]) for c, f in zip(zip(*rows), _SEGMENTS.split(", "))]
                if rows:
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, _SEGMENTS)


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _payload(kind: str, block: bytes) -> tuple[int, str | None]:
    """(payload bytes, payload digest or None) of a whole block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(line.lower().split(b": ", 1) for line in head.split(b"\r\n")[1:])
    if kind == "revisit":
        return int(fields[b"content-length"]), None
    if fields.get(b"transfer-encoding") == b"chunked":
        body = unchunked(body)
    return len(body), hashlib.sha256(body).hexdigest()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's size and digest are those of the payload put together again;
    a lost segment, a wrong length or a digest that differs from the header
    raises. A revisit's are those its record gives, and must be those of a
    response of the page that it refers to; else reading raises.
    """
    parts = segments(spark, folder)
    alone = parts.where("total = octet_length(block) AND number = 1")
    split = parts.where("NOT (total <=> octet_length(block) AND number = 1)")
    # Equal segments are one before they meet, however often a row was written;
    # a page's segments are its own group, and it comes back as often as written.
    kinds = ["origin", "number", "total", "type", "page_id", "refers_to", "digest", "block"]
    split = split.groupBy(*kinds).agg(F.count("*").alias("copies"))
    joined = split.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.sum(F.when(F.col("number") == 1, F.col("copies")).otherwise(0)).alias("copies"),
        F.max("total").alias("total"),
        F.max(F.when(F.col("number") == 1, F.struct("type", "page_id", "refers_to", "digest"))).alias("first"),
    )
    whole = joined.select(
        F.explode(F.expr("sequence(1L, greatest(copies, 1L))")),
        "total",
        "first.*",
        F.expr("parts.number = sequence(1L, CAST(size(parts) AS BIGINT))").alias("complete"),
        F.col("parts.block").alias("blocks"),
    ).drop("col")
    columns = ["total", "type", "page_id", "refers_to", "digest"]
    every = whole.select(*columns, "complete", "blocks").union(
        alone.select(*columns, F.lit(True), F.array("block"))
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for total, kind, page, digest, complete, blocks in zip(
                *(batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)), batch.column(6)
            ):
                block = b"".join(b.as_py() for b in blocks.values)
                if not complete or len(block) != total:
                    raise ValueError(f"page {page}: segments are missing or of another length")
                size, found = _payload(kind, block)
                if found is not None and found != digest:
                    raise ValueError(f"page {page}: the payload's digest differs from the header's")
                sizes.append(size)
                digests.append(digest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), batch.column(1), batch.column(3)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    pages = every.mapInArrow(
        check, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
    pages = staged(pages, "pages")
    # one row for each page referred to, however many refer to it
    asked = pages.where("record_type = 'revisit'").select(
        F.col("refers_to").alias("page_id"), "payload_digest", "payload_bytes"
    ).distinct()
    there = pages.where("record_type = 'response'").select("page_id", "payload_digest", "payload_bytes")
    wrong = asked.join(there, ["page_id", "payload_digest", "payload_bytes"], "left_anti").first()
    if wrong is not None:
        raise ValueError(f"a revisit differs from the response of page {wrong['page_id']}, or there is none")
    return pages
