"""WARC archives: segmented records with chunked HTTP bodies, written and read back.

Writing.  Payloads of at least ``MIN_REVISIT`` bytes that occur more than once
are stored under their smallest ``page_id``; the others become revisit records,
which never carry or shuffle the page.  A response block is an HTTP message in
chunked transfer framing; a block over ``SEGMENT_BYTES`` goes on in continuation
records.  Spark's text writer puts a bounded number of bounded records into each
gzipped archive of the shared folder.

Reading.  Each archive is parsed by its records' Content-Length.  Blocks in one
piece are decoded where they are read; segments are grouped by origin id,
ordered by number, checked against the total length, joined and decoded.  A
group is one page.

Defined cases: a null payload is empty; a null ``page_id`` is always a response;
rows with the smallest ``page_id`` of their payload are responses, repeated or
not; a response whose segments are missing, doubled or of the wrong total length
has null bytes and digest instead of failing the job; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.llm.common import checkpoint_dir, tidied
from burnlens.session import remove_at_exit

MIN_REVISIT = 100
#: Bytes of a block in one record, of one HTTP chunk, and records of one archive: a file holds about 18 MB at most.
SEGMENT_BYTES, CHUNK_BYTES, RECORDS_PER_FILE = 8192, 4096, 2048
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
CONTROL = re.compile("[\x00-\x1f\x7f]+")

RECORD = "page_id long, type string, refers_to long, origin string, segment int, total long, digest string, block binary"
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def stretches(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of up to ``size`` bytes that don't cut a UTF-8 character."""
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        while end < len(data) and data[end] & 0xC0 == 0x80 and end - start > size - 4:
            end -= 1
        yield data[start:end]
        start = end


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in stretches(payload, size)) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].partition(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        if len(out[-1]) != size or body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        at = line + 4 + size


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that close it (the writer adds them)."""
    head = "".join(f"{k}: {CONTROL.sub(' ', str(v))}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n%bContent-Length: %d\r\n\r\n%b" % (head.encode(), len(block), block)


def response_records(page_id: int | None, url: str | None, payload: bytes, unique: str) -> Iterator[bytes]:
    block = HTTP_HEAD + chunked(payload)
    parts = list(stretches(block, SEGMENT_BYTES))
    origin = f"<urn:x-page:{unique}>"
    digest = f"sha256:{hashlib.sha256(payload).hexdigest()}"
    for k, part in enumerate(parts, 1):
        fields = [
            ("WARC-Type", "response" if k == 1 else "continuation"),
            ("WARC-Record-ID", origin if k == 1 else f"<urn:x-page:{unique}:{k}>"),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url),
            ("Content-Type", "application/http; msgtype=response" if k == 1 else None),
            ("WARC-Payload-Digest", digest if k == 1 else None),
            ("X-Page-ID", page_id if k == 1 else None),
            ("WARC-Segment-Number", k if len(parts) > 1 else None),
            ("WARC-Segment-Origin-ID", origin if k > 1 else None),
            ("WARC-Segment-Total-Length", len(block) if k == len(parts) > 1 else None),
        ]
        yield record(fields, part)


def revisit_record(page_id: int, url: str | None, digest: str, refers_to: int, unique: str) -> bytes:
    fields = [
        ("WARC-Type", "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{unique}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
    ]
    return record(fields, b"")


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:head_end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = head_end + 4
        end = start + int(fields["content-length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length")
        yield fields, archive[start:end]
        at = end + 4


def decoded(block: bytes) -> bytes:
    """Payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    framed = any(k.strip().lower() == b"transfer-encoding" and b"chunked" in v.lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]))
    return dechunked(body) if framed else body


def reassembled(segments: list[dict]) -> bytes | None:
    """The block of one origin's segments, or None if they aren't whole."""
    ordered = sorted(segments, key=lambda s: s["segment"])
    if [s["segment"] for s in ordered] != list(range(1, len(ordered) + 1)):
        return None
    block = b"".join(s["block"] for s in ordered)
    return block if ordered[-1]["total"] == len(block) else None


def pages_with_digest(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def revisits(pages: DataFrame) -> DataFrame:
    """``(page_id, url, digest, refers_to)`` of the pages stored elsewhere."""
    slim = pages.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull()).select("page_id", "url", "digest")
    stored = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("high")).where("high > refers_to").select("digest", "refers_to")
    return slim.join(stored, "digest").where("page_id > refers_to").select("page_id", "url", "digest", "refers_to")


def write_archives(pages: DataFrame, path: str) -> None:
    """The records of ``pages`` (page_id, url, html) as gzipped archives under ``path``."""
    full = pages_with_digest(pages)
    elsewhere = revisits(full)

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[bytes] = []
            for page_id, url, payload in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload"))):
                n += 1
                out += response_records(page_id, url, payload, f"{page_id}:{task}-{n}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                n += 1
                out.append(revisit_record(row["page_id"], row["url"], row["digest"], row["refers_to"], f"{row['page_id']}:r{task}-{n}"))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    kept = full.join(elsewhere.select("page_id", "digest").distinct(), ["page_id", "digest"], "left_anti")
    records = kept.select("page_id", "url", "payload").mapInArrow(tidied(responses), "value binary").union(elsewhere.mapInArrow(tidied(repeats), "value binary"))
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "type", "refers_to", "origin", "segment", "total", "digest", "block"]
        number = lambda v: None if v in (None, "None") else int(v)
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for f, block in parse(zlib.decompress(content.as_py(), 31) if content.as_py() else b""):
                    segment = number(f.get("warc-segment-number"))
                    origin = f.get("warc-segment-origin-id") or (f["warc-record-id"] if segment else None)
                    rows.append((number(f.get("x-page-id")), f["warc-type"], number(f.get("x-refers-to-page-id")), origin, segment, number(f.get("warc-segment-total-length")), f.get("warc-payload-digest", "").removeprefix("sha256:"), block))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(tidied(run), RECORD)


def _pages(found: Iterator[tuple[int | None, bytes | None]], with_payload: bool) -> pa.RecordBatch:
    ids, sizes, digests, payloads = [], [], [], []
    for page_id, block in found:
        payload = None
        if block is not None:
            try:
                payload = decoded(block)
            except ValueError:  # framing that doesn't add up: not whole
                pass
        ids.append(page_id)
        sizes.append(None if payload is None else len(payload))
        digests.append(None if payload is None else hashlib.sha256(payload).hexdigest())
        payloads.append(payload if with_payload else None)
    n = len(ids)
    columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(["response"] * n, pa.string()), pa.nulls(n, pa.int64()), pa.array(payloads, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def read_pages(records: DataFrame, with_payload: bool = True) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)``;
    a revisit has its response's size and digest and no payload of its own."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _pages(zip(batch.column("page_id").to_pylist(), batch.column("block").to_pylist()), with_payload)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = zip(batch.column("page_id").to_pylist(), batch.column("segments"))
            yield _pages(((p, reassembled(s.as_py())) for p, s in groups), with_payload)

    single = records.where("type = 'response' AND origin IS NULL").select("page_id", "block").mapInArrow(tidied(whole), PAGE)
    segments = records.where("origin IS NOT NULL").groupBy("origin").agg(F.max("page_id").alias("page_id"), F.collect_list(F.struct("segment", "total", "block")).alias("segments"))
    responses = single.union(segments.select("page_id", "segments").mapInArrow(tidied(joined), PAGE))
    stored = responses.where("page_id IS NOT NULL").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    repeats = (
        records.where("type = 'revisit'")
        .select("page_id", "refers_to", F.col("digest").alias("payload_digest"))
        .join(stored, ["refers_to", "payload_digest"], "left")
        .select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to", F.lit(None).cast("binary").alias("payload"))
    )
    return responses.union(repeats)


def query(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = f"{checkpoint_dir(spark)}/burnlens/warc-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    write_archives(pages, path)
    return read_pages(read_records(spark, path), with_payload=False).drop("payload")


SQL = """
WITH p AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id > f.first_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest
"""
