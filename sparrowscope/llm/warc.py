"""WARC archives: writing captures, reading records, assembling transactions.

A capture is written as three records: request, response (or revisit of an equal payload)
and metadata; request and metadata name the response as concurrent. Every record is a
gzip member of its own. Spark's own file writer makes the files, a row for each capture,
so that a retried task leaves no half archive and any store that Spark can write to will
do. The line separator that this writer puts after a row is an empty gzip member.

Reading gives a row per record. `assemble` joins requests, responses and metadata through
their concurrent-to identifiers into one nested row per capture.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparrowscope.llm.common import map_texts, store
from sparrowscope.sources.shared import fresh_path

# Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
LEVEL = 3
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_NAMES = uuid.UUID("5f0c7f4e-6f0e-5d0b-9a53-3d6f1c9e8a11")

RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def record_id(page_id: int | None, url: str | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}|{kind}|{digest}|{url}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode("utf-8", "surrogatepass") for name, value in headers)]
    lines.append(b"Content-Length: %d" % len(block))
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def warcinfo(date: str) -> bytes:
    block = b"software: sparrowscope\r\nformat: WARC File Format 1.1\r\n"
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
         ("Content-Type", "application/warc-fields")],
        block,
    )


def capture_members(page_id: int | None, url: str | None, payload: bytes, revisits: str | None, date: str) -> bytes:
    """Request, response or revisit, and metadata record of one page."""
    digest = hashlib.sha1(payload)
    packed, plain = base64.b32encode(digest.digest()).decode(), digest.hexdigest()
    safe = None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
    uri = [] if safe is None else [("WARC-Target-URI", safe)]
    main = record_id(page_id, url, plain, "response")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = [("WARC-Type", "response")] if revisits is None else [
        ("WARC-Type", "revisit"), ("WARC-Refers-To", revisits), ("WARC-Profile", REVISIT_PROFILE)]
    host, _, path = (safe or "").partition("://")[2].partition("/")
    asked = f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode("utf-8", "surrogatepass")
    noted = b"" if page_id is None else b"page-id: %d\r\n" % page_id

    def beside(name: str) -> list[tuple[str, str]]:
        return [("WARC-Type", name), ("WARC-Record-ID", record_id(page_id, url, plain, name)),
                ("WARC-Date", date), *uri, ("WARC-Concurrent-To", main)]

    return b"".join(
        [
            _member([*beside("request"), ("Content-Type", "application/http; msgtype=request")], asked),
            _member(
                [*kind, ("WARC-Record-ID", main), ("WARC-Date", date), *uri,
                 ("WARC-Payload-Digest", f"sha1:{packed}"), ("Content-Type", "application/http; msgtype=response")],
                http + (payload if revisits is None else b""),
            ),
            _member([*beside("metadata"), ("Content-Type", "application/warc-fields")], noted),
        ]
    )


def write_captures(
    pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES,
    id: str = "page_id", url: str = "url", html: str = "html",
) -> None:
    """Write a capture per row of `pages` below `path`; null html is an empty payload,
    null urls have no target header. Of equal payloads of at least `revisit_bytes` bytes
    the row with the largest id is the response, the others revisit it; rows that tie for
    the largest id are all responses. Rows equal in id, url and html are one capture for
    the reader. Other columns are not read."""
    rows = pages.select(
        pages[id].cast("bigint").alias("page_id"), pages[url].alias("url"),
        F.coalesce(pages[html], F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_bytes
    # Only digests that occur more than once are joined back.
    groups = rows.where(large).groupBy("digest").agg(
        F.max_by(F.struct("page_id", "url"), F.col("page_id")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    groups = groups.where("n > 1 AND first.page_id IS NOT NULL").select(F.col("digest").alias("equal"), "first")
    groups = store(groups, "equal-payloads")
    # Small payloads match nothing; a key of their own keeps them from meeting in one task.
    key = F.when(large, F.col("digest")).otherwise(F.concat(F.lit("small-"), F.xxhash64("page_id", "url")))
    joined = rows.withColumn("key", key).join(groups, F.col("key") == F.col("equal"), "left")
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    joined = joined.select(
        "page_id", "url", "payload", "digest", F.when(revisits, F.col("first")).alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            made = [] if opened else [warcinfo(date)]
            opened = True
            for page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                seen = first and record_id(first["page_id"], first["url"], digest, "response")
                made.append(capture_members(page_id, url, payload, seen, date))
            yield pa.record_batch([pa.array(made, pa.binary())], names=["value"])

    members = map_texts(joined, run, "value binary").select(F.col("value").cast("string"))
    members.write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1")).text(path)


def _blocks(content: bytes) -> Iterator[bytes]:
    """Decompressed gzip members one after another; plain content as it is."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("archive ends inside a gzip member")
            piece = view[at : at + 16_384]
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        yield b"".join(parts)


def parse_records(content: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers (lower-case names) and block of every record, by Content-Length."""
    rest = b""
    for block in _blocks(content):
        rest = rest + block if rest else block
        at = 0
        while at < len(rest):
            if rest.startswith(b"\r\n", at):
                at += 2
                continue
            end = rest.find(b"\r\n\r\n", at)
            if end < 0:
                break
            version, *lines = rest[at:end].split(b"\r\n")
            if not version.startswith(b"WARC/"):
                raise ValueError("no WARC record")
            headers = []
            for line in lines:
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers.append((name.strip().lower(), value.strip()))
            size = int(dict(headers)["content-length"])
            if end + 4 + size > len(rest):
                break
            yield headers, rest[end + 4 : end + 4 + size]
            at = end + 4 + size
        rest = rest[at:]
    if rest.strip(b"\r\n"):
        raise ValueError("archive ends inside a record")


def _row(headers: list[tuple[str, str]], block: bytes, payloads: bool) -> dict:
    known = dict(headers)
    kind = known.get("warc-type")
    row = {
        "record_id": known.get("warc-record-id"), "type": kind, "uri": known.get("warc-target-uri"),
        "date": known.get("warc-date"), "refers_to": known.get("warc-refers-to"),
        "concurrent_to": [value for name, value in headers if name == "warc-concurrent-to"],
    }
    digest = known.get("warc-payload-digest", "")
    if digest.startswith("sha1:"):
        row["payload_digest"] = base64.b32decode(digest[5:].upper()).hex()
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            found = hashlib.sha1(payload).hexdigest()
            if row.setdefault("payload_digest", found) != found:
                raise ValueError(f"payload of {row['record_id']} does not match its digest")
            row["payload_bytes"] = len(payload)
            row["payload"] = payload if payloads else None
        else:
            for line in http.split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length":
                    row["payload_bytes"] = int(value)
    elif kind == "metadata":
        lines = [line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n") if line.strip()]
        row["fields"] = [(name.strip(), value.strip()) for name, _, value in lines]
    return row


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record of all archives below `path`, compressed or not; payloads only on
    demand. Damaged archives and payloads that differ from their digest are errors. An
    archive is read as a whole, so it has to fit in a task."""
    schema = pa.schema(
        [
            ("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("date", pa.string()),
            ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
            ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, size = [], 0
                for headers, block in parse_records(content or b""):
                    rows.append(_row(headers, block, payloads))
                    size += len(block) if payloads else 0
                    if len(rows) >= 2_000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return map_texts(files, run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its own columns, `requests` and `metadata`
    (arrays of records that name it as concurrent, or that it names).

    Captures without such records have empty arrays; requests and metadata that no capture
    claims, and records without an id, are left out. Records with equal ids are one.
    """
    main = records.where(F.col("type").isin("response", "revisit") & F.col("record_id").isNotNull())
    beside = records.where(F.col("type").isin("request", "metadata") & F.col("record_id").isNotNull())
    # Who names whom may go either way.
    named = beside.select("record_id", F.explode("concurrent_to").alias("capture")).union(
        main.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture"))
    ).distinct()
    kept = beside.select("record_id", "type", "uri", "date", F.map_entries("fields").alias("fields"))
    parts = kept.join(named, "record_id").groupBy("capture").agg(
        *[
            F.collect_set(F.when(F.col("type") == kind, F.struct("record_id", "uri", "date", "fields"))).alias(name)
            for kind, name in (("request", "requests"), ("metadata", "metadata"))
        ]
    )
    captures = main.dropDuplicates(["record_id"]).join(parts, F.col("record_id") == F.col("capture"), "left")
    entry = "array<struct<record_id:string,uri:string,date:string,fields:array<struct<key:string,value:string>>>>"
    arrays = [F.coalesce(name, F.array().cast(entry)).alias(name) for name in ("requests", "metadata")]
    return captures.select(
        "record_id", "type", "uri", "date", "payload_bytes", "payload_digest", "refers_to", "payload", *arrays
    )


def field(entries: str, name: str):
    """First value of a field in an array of metadata records."""
    values = F.flatten(F.transform(entries, lambda m: F.coalesce(m["fields"], F.array().cast("array<struct<key:string,value:string>>"))))
    return F.get(F.filter(values, lambda e: e["key"] == name), F.lit(0))["value"]


def captured_pages(spark: SparkSession, path: str) -> DataFrame:
    """Per capture the page id of its metadata, payload size and digest, record type and
    the page id of the response that a revisit refers to. Captures without a metadata
    record have a null page id, revisits of a response that is not there a null one to
    refer to; captures of equal rows are one. A folder without records gives no rows."""
    # Archives are parsed once; `assemble` looks at the records several times.
    records = store(read_records(spark, path), "records")
    captures = assemble(records).select(
        "record_id", field("metadata", "page-id").cast("bigint").alias("page_id"), "payload_bytes",
        "payload_digest", F.col("type").alias("record_type"), "refers_to",
    )
    captures = store(captures, "captures")
    originals = captures.where("record_type = 'response'").select(
        F.col("record_id").alias("original"), F.col("page_id").alias("original_page")
    )
    revisits = captures.where("record_type = 'revisit'").join(
        originals, F.col("refers_to") == F.col("original"), "left"
    )
    names = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return (
        captures.where("record_type = 'response'")
        .select(*names, F.lit(None).cast("bigint").alias("refers_to"))
        .union(revisits.select(*names, "original_page"))
    )


def archive_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "warc")
