"""WARC: archives of page captures, and their assembly into transactions.

``write_archives`` turns pages into gzipped WARC/1.1 files of request, response or
revisit, and metadata records in the shared folder; ``read_records`` parses such files into one row per
record, and ``assemble`` brings the records of a capture together: requests and
metadata name their response in ``WARC-Concurrent-To``, so that id (its own id for a
response) is the key under which a capture's records meet. One nested row per
capture results. ``resolve`` follows ``WARC-Refers-To`` of revisits to the response.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, those with the
smallest page_id are responses and the others revisit it.

Defined results: null html counts as empty. A null page_id is never referred to
where another page has the payload; pages alike in every column share record ids and
give one row each. A damaged record (no version line, a header or block cut short, a
payload that differs from its digest) gives a row whose ``error`` says where and why; reading goes on at the
next version line, and of a damaged gzip stream with what could be inflated.
Damaged records are left out of captures. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.sources import scratch

MIN_REVISIT = 100
#: Bytes of payload that a file is meant to have (by the mean length).
ARCHIVE_BYTES = 16 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def record_id(role: str, page_id: int | None, url: str, digest: str) -> str:
    return f"<{uuid.UUID(bytes=hashlib.md5(f'{role}|{page_id}|{url}|{digest}'.encode()).digest()).urn}>"


def record(kind: str, own_id: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {own_id}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def escaped(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def capture(page_id: int | None, url: str, payload: bytes, digest: str, first: int | None, first_url: str | None, revisit: bool) -> bytes:
    """The request, response or revisit, and metadata records of one page."""
    uri = escaped(url)
    own = record_id("response", page_id, uri, digest)
    target = {"WARC-Target-URI": uri}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {**target, "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha256:{digest}"}
    if revisit:
        other = escaped(first_url or "")
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id("response", first, other, digest), "WARC-Refers-To-Target-URI": other, "WARC-Refers-To-Date": DATE}
    beside = {**target, "WARC-Concurrent-To": own}
    fields = f"page-id: {'' if page_id is None else page_id}\r\n"
    return b"".join(
        [
            record("request", record_id("request", page_id, uri, digest), {**beside, "Content-Type": "application/http; msgtype=request"}, f"GET {uri} HTTP/1.1\r\n\r\n".encode()),
            record("revisit" if revisit else "response", own, headers, head if revisit else head + payload),
            record("metadata", record_id("metadata", page_id, uri, digest), {**beside, "Content-Type": "application/warc-fields"}, fields.encode()),
        ]
    )


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # Spark's writer ends each row with the line feed that ends a record.
        rows = [capture(*row).removesuffix(b"\n").decode() for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        yield pa.record_batch([pa.array(rows, pa.string())], ["value"])


def write_archives(pages: DataFrame, folder: str) -> str:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files below ``folder``; returns their folder."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= MIN_REVISIT
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    groups = rows.filter(long_enough).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
    shared = scratch.materialise(groups.filter("n > 1").select("digest", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url")), folder, "shared_payloads")
    revisit = long_enough & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    mean = pages.agg(F.avg(F.octet_length("html"))).head()[0] or 1
    captures = rows.join(shared, "digest", "left").select("page_id", "url", "payload", "digest", "first", "first_url", revisit.alias("revisit"))
    writer = captures.mapInArrow(_write, "value string").write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES // max(mean, 1))))
    writer.text(f"{folder}/archives")
    return f"{folder}/archives"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row of a column ``warc`` for each file below ``path``, as it is."""
    return spark.read.format("binaryFile").load(path).select(F.col("content").alias("warc"))


def inflated(data: bytes) -> tuple[bytes, str | None]:
    """The bytes of a file of any number of gzip members, or of one that isn't compressed, and what was wrong."""
    if not data.startswith(b"\x1f\x8b"):
        return data, None
    parts = []
    while data:
        stream = zlib.decompressobj(31)
        try:
            parts.append(stream.decompress(data))
        except zlib.error as e:
            parts.append(_rescued(data))
            return b"".join(parts), str(e)
        if not stream.eof:
            return b"".join(parts), "gzip stream is cut short"
        data = stream.unused_data
    return b"".join(parts), None


def _rescued(data: bytes) -> bytes:
    """What a damaged gzip member gives before its damage, to the byte."""
    stream, parts, at = zlib.decompressobj(31), [], 0
    for size in (4096, 1):
        try:
            while at < len(data):
                before = stream.copy()
                parts.append(stream.decompress(data[at : at + size]))
                at += size
        except zlib.error:
            stream = before
    return b"".join(parts)


def _one(archive: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block and end of the record at byte ``at``."""
    end = archive.find(_END, at)
    if not archive.startswith(b"WARC/", at):
        raise ValueError("no version line")
    if end < 0:
        raise ValueError("header is cut short")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in archive[at:end].decode().split("\r\n")[1:])}
    if not headers.get("content-length", "").isdecimal() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise ValueError("header lacks a mandatory field")
    begin, size = end + 4, int(headers["content-length"])
    if archive[begin + size : begin + size + 4] != _END:
        raise ValueError("block is cut short or its length differs")
    return headers, archive[begin : begin + size], begin + size + 4


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers, block and error of each record; after a damaged one it goes on at the next version line."""
    at = 0
    while at < len(archive):
        try:
            headers, block, end = _one(archive, at)
            yield headers, block, None
        except ValueError as e:
            yield {}, b"", f"byte {at}: {e}"
            nxt = archive.find(_END + b"WARC/", at)
            end = nxt + 4 if nxt >= 0 else len(archive)
        at = end


_RECORD_DDL = "record_id string, type string, concurrent_to string, refers_to string, url string, digest string, fields map<string,string>, payload binary, payload_bytes long, payload_sha256 string, error string"
_RECORD = pa.schema(
    [(n, pa.string()) for n in ("record_id", "type", "concurrent_to", "refers_to", "url", "digest")]
    + [("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("error", pa.string())]
)


def _row(headers: dict[str, str], block: bytes, error: str | None, with_payload: bool) -> tuple:
    kind = headers.get("warc-type")
    payload = block.partition(_END)[2] if kind == "response" else None
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
    measured = None if payload is None else hashlib.sha256(payload).hexdigest()
    if measured is not None and measured != digest:
        error = "payload differs from its digest"
    lines = block.decode(errors="replace").split("\r\n") if kind == "metadata" else []
    fields = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines if line)] if kind == "metadata" else None
    size = None if payload is None else len(payload)
    return headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"), headers.get("warc-target-uri"), digest, fields, payload if with_payload else None, size, measured, error


def _parse(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                archive, damage = inflated(file)
                rows = [_row(*r, with_payload) for r in records(archive)]
                if damage:
                    rows.append(_row({}, b"", damage, False))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD.types, strict=True)], schema=_RECORD)

    return run


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record, with its payload's measured length and hash; without payloads they are still checked against their digests."""
    return archives.select("warc").mapInArrow(_parse(with_payload), _RECORD_DDL)


def assemble(recs: DataFrame) -> DataFrame:
    """One row per capture: ``capture`` holds its request, response (or revisit) and metadata records."""
    keyed = recs.filter("error is null").withColumn("key", F.coalesce("concurrent_to", "record_id"))

    def one(role: str, *kinds: str):
        parts = F.struct("record_id", "type", "refers_to", "url", "digest", "fields", "payload", "payload_bytes", "payload_sha256")
        return F.first(F.when(F.col("type").isin(*kinds), parts), ignorenulls=True).alias(role)

    main = F.count_if(F.col("type").isin("response", "revisit"))
    groups = keyed.groupBy("key").agg(one("request", "request"), one("response", "response", "revisit"), one("metadata", "metadata"), main.alias("n"))
    return groups.filter("n > 0").select(F.struct("request", "response", "metadata").alias("capture"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).drop("copy")


def resolve(captures: DataFrame, folder: str, *kept: str) -> DataFrame:
    """captures with ``original``: the columns ``kept`` of the response that a revisit refers to, by its record id; null for responses.

    ``captures`` is read several times and had better be a table. What is referred to becomes a table
    below ``folder``, so that Spark can split the many revisits of one response.
    """
    revisit = F.col("capture.response.type") == "revisit"
    revisits = captures.filter(revisit).withColumn("__refers", F.col("capture.response.refers_to"))
    responses = captures.filter(~revisit)
    wanted = revisits.select("__refers").distinct()
    named = responses.select(F.col("capture.response.record_id").alias("__refers"), F.struct(*kept).alias("original"))
    originals = scratch.materialise(named.join(wanted, "__refers", "left_semi").groupBy("__refers").agg(F.min("original").alias("original")), folder, "originals")
    none = F.lit(None).cast(originals.schema["original"].dataType).alias("original")
    return responses.select("*", none).unionByName(revisits.join(originals, "__refers", "left").drop("__refers"))


def warc_captures(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` into archives, read them back and assemble their captures, a table in the shared folder."""
    spark = pages.sparkSession
    folder = scratch.new_folder(spark, "warc")
    found = assemble(read_records(read_archives(spark, write_archives(pages, folder)), with_payload))
    return scratch.materialise(found, folder, "captures")
