"""WARC archives: writing pages as segmented records, and putting them together again.

An archive is a table of blocks; a block is a run of gzip members, one for each record, as in
a .warc.gz file. Spark writes and reads the table, so a lost task leaves no part behind.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.llm.tables import pick
from goldweave.operators.joins import join_unique

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
BLOCK_BYTES = 1 << 20
ARCHIVE = "archive long, block long, content binary"
_RECORD = ("record_id string, record_type string, page_id long, refers_to long, digest string, "
           "origin string, segment long, total long, block binary")
_RESULT = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, problem string")


_CHUNK_SIZE = re.compile(rb"[0-9A-Fa-f]+")
_PAGE = re.compile(r"<urn:page:(-?[0-9]+);[^>]*>")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; chunk extensions and trailers go."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size line")
        told = body[at:end].split(b";")[0].strip(b" \t")
        if not _CHUNK_SIZE.fullmatch(told):
            raise ValueError("a chunk's size is no hexadecimal number")
        size = int(told, 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        out.append(body[at:at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{k}: {v}" for k, v in headers if v is not None],
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _name(page: int | None, row: int | str) -> str:
    return f"<urn:page:{'none' if page is None else page};row={row}>"


def page_records(page: int | None, url: str | None, payload: bytes, refers_to: str | None,
                 row: int | str, segment_bytes: int) -> Iterator[bytes]:
    """A page as one record, or as a first record and its continuations.

    ``refers_to`` is the id of the record that a revisit refers to.
    """
    own = _name(page, row)
    # A header value is one line.
    target = None if url is None else "".join(c for c in url if c.isprintable())
    common = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
              ("Content-Type", "application/http; msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        yield record(
            [("WARC-Type", "revisit"), *common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to)],
            http + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *common], block)
        return
    yield record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)],
                 block[:segment_bytes])
    for k, at in enumerate(range(segment_bytes, len(block), segment_bytes), start=2):
        last = at + segment_bytes >= len(block)
        yield record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]};part={k}>"),
             ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
             ("WARC-Segment-Total-Length", len(block) if last else None)],
            block[at:at + segment_bytes])


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0,
               segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record per row of ``page_id`` (an integer), ``url`` and ``html`` (null: empty).

    Of the rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest
    page_id are responses (a page that is repeated as a whole is written as often), the others
    are revisits, and refer to the record of the first such row. A null page_id is the largest.
    Rows are looked up by payload digest in a join whose hot keys Spark splits. An empty table
    writes a table without rows.
    """
    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    # Given by the file and the place in it, so a task that runs again numbers its rows alike.
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("sum", F.sha1("payload"))
    firsts = rows.groupBy("sum").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page"), F.col("row").alias("row"))).alias("first"))
    both = join_unique(rows, firsts, ["sum"], "inner").select(
        "page_id", "url", "payload", "row", "first.page", F.col("first.row").alias("of"),
        (~F.col("page_id").eqNullSafe(F.col("first.page"))
         & (F.octet_length("payload") >= min_bytes)).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = block = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int64()), pa.array([block], pa.int64()),
                 pa.array([b"".join(held)], pa.binary())], names=["archive", "block", "content"])

        for batch in batches:
            for page, url, payload, row, first, of, revisit in zip(
                    *(batch.column(k) for k in range(7)), strict=True):
                refers_to = _name(first.as_py(), of.as_py()) if revisit.as_py() else None
                for one in page_records(page.as_py(), url.as_py(), payload.as_py(), refers_to,
                                        row.as_py(), segment_bytes):
                    held.append(gzip.compress(one, 6, mtime=0))
                    size += len(held[-1])
                    if size >= BLOCK_BYTES:
                        yield flush()
                        held, size, block = [], 0, block + 1
        if held:
            yield flush()

    both.mapInArrow(run, ARCHIVE).write.option("compression", "none").parquet(path)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a run of gzip members."""
    while content:
        member = zlib.decompressobj(31)
        data = member.decompress(content)
        content = member.unused_data
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("a record does not start with its version")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            start = end + 4
            stop = start + int(headers["content-length"])
            yield headers, data[start:stop]
            at = stop + 4


def _page_of(name: str | None) -> int | None:
    """The page of a record that was written here; none for ids of others."""
    match = _PAGE.fullmatch(name or "")
    return int(match[1]) if match else None


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def read_records(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    """Records that are whole, or those that are segments of others."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows: list[list] = [[] for _ in range(9)]
                for h, block in parse_records(content.as_py()):
                    if ("warc-segment-number" in h) != segmented:
                        continue
                    own = h["warc-record-id"]
                    values = (own, h["warc-type"], _page_of(own), _page_of(h.get("warc-refers-to")),
                              h.get("warc-payload-digest"), h.get("warc-segment-origin-id", own),
                              _number(h.get("warc-segment-number")),
                              _number(h.get("warc-segment-total-length")), block)
                    for c, v in zip(rows, values, strict=True):
                        c.append(v)
                s, n = pa.string(), pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, [s, s, n, n, s, s, n, n, pa.binary()],
                                                    strict=True)],
                    names=[f.split()[0] for f in _RECORD.split(", ")])

    archive = spark.read.schema(ARCHIVE).parquet(path)
    return archive.select("content").mapInArrow(run, _RECORD)


def reassembled(segments: DataFrame) -> DataFrame:
    """One row per origin: its segments as ``blocks`` in order of their numbers, and what is wrong.

    The segments of one origin are one payload, which is as large as a row may be.
    """
    ordered = F.array_sort(F.collect_list(F.struct("segment", "block")))
    first = F.max(F.when(F.col("segment") == 1, F.struct("record_type", "page_id", "refers_to", "digest")))
    grouped = segments.groupBy("origin").agg(
        ordered.alias("parts"), F.max("total").alias("total"), first.alias("head"))
    numbers = F.transform("parts", lambda p: p["segment"])
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    return grouped.select(
        F.col("head.record_type").alias("record_type"), F.col("head.page_id").alias("page_id"),
        F.col("head.refers_to").alias("refers_to"), F.col("head.digest").alias("digest"),
        F.transform("parts", lambda p: p["block"]).alias("blocks"),
        F.when(numbers != F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long")),
               F.lit("segments missing or repeated"))
        .when(F.col("total").isNull(), F.lit("no total length"))
        .when(F.col("total") != length, F.lit("wrong total length"))
        .alias("problem"))


def decode_block(block: bytes, record_type: str, digest: str | None) -> tuple:
    """Payload size, digest and what is wrong, from the HTTP message in a record."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None, None, "no end of the HTTP header"
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    told = digest.removeprefix("sha1:") if digest else None
    if record_type == "revisit":
        return int(fields.get(b"content-length", b"0")), told, None
    try:
        payload = unchunked(body) if fields.get(b"transfer-encoding", b"").lower() == b"chunked" else body
    except ValueError as e:
        return None, None, str(e)
    own = digest_of(payload)
    return len(payload), own, None if told in (None, own) else "wrong payload digest"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: its payload's size and digest, the kind of record and what it refers to.

    ``problem`` tells of missing segments, wrong total lengths, broken framing or a digest
    that differs, and is null for a sound record. Records with ids of others have no page_id.
    """
    columns = ["record_type", "page_id", "refers_to", "digest", "blocks", "problem"]
    whole = read_records(spark, path, segmented=False).withColumns(
        {"blocks": F.array("block"), "problem": F.lit(None).cast("string")}).select(*columns)
    joined = reassembled(read_records(spark, path, segmented=True)).select(*columns)

    def run(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in range(3)]
            for kind, digest, blocks, problem in zip(
                    *(batch.column(k).to_pylist() for k in (0, 3, 4, 5)), strict=True):
                values = (None, None, problem) if problem else decode_block(b"".join(blocks), kind, digest)
                for c, v in zip(rows, values, strict=True):
                    c.append(v)
            size, digest, problem = (pa.array(c, t) for c, t in zip(
                rows, [pa.int64(), pa.string(), pa.string()], strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), size, digest, batch.column(0), batch.column(2), problem],
                names=[f.split()[0] for f in _RESULT.split(", ")])

    return whole.unionByName(joined).mapInArrow(run, _RESULT)
