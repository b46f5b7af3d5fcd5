"""WARC archives: records written by Spark, segmented records put together again.

Writing: equal payloads of some size are stored once.  The first page (smallest id) gets a ``response`` record, the
others ``revisit`` records that name it.  A response block is an HTTP message in chunked transfer framing; a block
longer than ``segment_bytes`` is cut into a first record and ``continuation`` records, the last of which states the
total length.  Records are bytes in a string column, and Spark's text sink writes them, so any file system will do and
a lost task leaves nothing behind.

Reading: files are parsed record by record, by their stated lengths.  Whole records are decoded where they are read;
segments are grouped by the identifier of their first record, put in order of their numbers, checked for gaps and
against the total length, and decoded as one block.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, saved

#: Payloads under this size are never replaced by a revisit.
LEAST_SHARED = 100
END = b"\r\n\r\n"
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
     ("refers_to", pa.string()), ("segment", pa.int32()), ("origin", pa.string()), ("total_length", pa.int64()),
     ("block", pa.binary())]
)
RECORD_DDL = (
    "record_id string, record_type string, url string, payload_digest string, refers_to string, segment int, "
    "origin string, total_length long, block binary"
)
PAGE = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("valid", pa.bool_())]
)
PAGE_DDL = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, valid boolean"
)


def chunked(payload: bytes, size: int = 16_384) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        own = payload[at : at + size]
        parts += [b"%x\r\n" % len(own), own, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload in ``body``, or None if the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            return None
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            return None
        if size == 0:
            return b"".join(parts)
        at = line + 2 + size
        if size < 0 or body[at : at + 2] != b"\r\n":
            return None
        parts.append(body[line + 2 : at])
        at += 2


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page(urn: str) -> int | None:
    number = urn.split(":")[2]
    return int(number) if number else None


def page_records(
    page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, serial: str, segment_bytes: int
) -> Iterator[bytes]:
    """The records of one page, each without the line ends that close it."""
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    http.append(f"Content-Length: {len(payload)}" if revisit else "Transfer-Encoding: chunked")
    block = "\r\n".join(http).encode() + END + (b"" if revisit else chunked(payload))
    record_id = f"<{_urn(page_id)}:{serial}>"
    common = [f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        common.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    count = max(1, -(-len(block) // segment_bytes))
    for n in range(count):
        own = block[n * segment_bytes : (n + 1) * segment_bytes]
        head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'continuation' if n else 'response'}"]
        head.append(f"WARC-Record-ID: {record_id if n == 0 else record_id[:-1] + f':{n + 1}>'}")
        head += common
        if n == 0:
            head.append(f"WARC-Payload-Digest: sha256:{digest}")
        if revisit:
            head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_urn(first)}>"]
        if count > 1:
            head.append(f"WARC-Segment-Number: {n + 1}")
            if n:
                head.append(f"WARC-Segment-Origin-ID: {record_id}")
            if n == count - 1:
                head.append(f"WARC-Segment-Total-Length: {len(block)}")
        head.append(f"Content-Length: {len(own)}")
        yield "\r\n".join(head).encode() + END + own


def write_warc(pages: DataFrame, path: str, segment_bytes: int = 1 << 16, records_per_file: int = 5_000) -> None:
    """Write ``page_id, url, html`` rows as gzipped WARC files below ``path``; other columns are not read.

    A null html is an empty payload; a null url leaves out the header; an empty table writes no record.  Rows that share
    the smallest id of a payload are all responses.  ``segment_bytes`` times ``records_per_file`` bounds a file.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    large = rows.where(F.octet_length("payload") >= LEAST_SHARED)
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = saved(shared.select(F.col("digest").alias("shared_digest"), "first"), "shared")
    same = (F.col("digest") == F.col("shared_digest")) & (F.octet_length("payload") >= LEAST_SHARED)
    marked = rows.join(shared, same, "left").select(
        "page_id", "url", "payload", "digest", "first",
        F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("shared_digest").isNotNull(), F.lit(False)).alias("revisit"),
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page_id, url, own, digest, first, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                out += page_records(page_id, url, own, digest, first, revisit, f"{part}.{n}", segment_bytes)
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    bounded_batches(pages.sparkSession)
    records = marked.mapInArrow(build, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of one archive; a truncated last record comes with what is left of its block."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        head["block"] = stream.read(int(head["content-length"]))
        yield head


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``, gzipped or plain; each file is parsed by one task, a record at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                stream = io.BytesIO(content.as_py())
                if stream.getbuffer()[:2] == b"\x1f\x8b":
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
                rows, size = [], 0
                for head in parse_records(stream):
                    segment, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
                    own_id = head.get("warc-record-id", "").strip("<>")
                    origin = head.get("warc-segment-origin-id", "").strip("<>") or own_id
                    rows.append(
                        (own_id, head.get("warc-type"), head.get("warc-target-uri"),
                         head.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                         head.get("warc-refers-to", "").strip("<>") or None, segment and int(segment), origin,
                         total and int(total), head["block"])
                    )
                    size += len(head["block"])
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD)], schema=RECORD)

    bounded_batches(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, RECORD_DDL)


def _decoded(record_id: str, kind: str, url: str | None, digest: str | None, refers_to: str | None, block: bytes, whole: bool) -> tuple:
    head, _, body = block.partition(END)
    fields = dict(x.split(b": ", 1) for x in head.lower().split(b"\r\n")[1:] if b": " in x)
    if kind == "revisit":
        return _page(record_id), url, kind, _page(refers_to or "urn:page:"), int(fields.get(b"content-length", b"0")), digest, None, whole
    payload = unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
    found = None if payload is None else hashlib.sha256(payload).hexdigest()
    size = None if payload is None else len(payload)
    return _page(record_id), url, kind, None, size, found, payload, whole and found is not None and digest in (None, found)


def _pages(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(PAGE), PAGE)], schema=PAGE)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``.

    ``valid`` is false where segments are missing, lengths don't add up, the framing is broken or the digest differs; such
    a row is kept.  Continuations without a first record give a row without a type.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pages([_decoded(*row, True) for row in zip(*(c.to_pylist() for c in batch.columns))])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None  # origin, type, url, digest, parts, next number, total, in order

        def close() -> pa.RecordBatch:
            origin, kind, url, digest, parts, _, total, good = now
            block = b"".join(parts)
            return _pages([_decoded(origin, kind, url, digest, None, block, good and kind is not None and total == len(block))])

        for batch in batches:
            for origin, segment, kind, url, digest, total, block in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != origin:
                    if now is not None:
                        yield close()
                    now = [origin, None, None, None, [], 1, None, True]
                if kind != "continuation":
                    now[1:4] = kind, url, digest
                now[4].append(block)
                now[7] = now[7] and segment == now[5]
                now[5] += 1
                now[6] = total if total is not None else now[6]
        if now is not None:
            yield close()

    records = read_records(spark, path)
    single = records.where(F.col("segment").isNull()).select("record_id", "record_type", "url", "payload_digest", "refers_to", "block")
    parts = records.where(F.col("segment").isNotNull()).select("origin", "segment", "record_type", "url", "payload_digest", "total_length", "block")
    parts = parts.repartition("origin").sortWithinPartitions("origin", "segment")
    return single.mapInArrow(whole, PAGE_DDL).unionByName(parts.mapInArrow(joined, PAGE_DDL))
