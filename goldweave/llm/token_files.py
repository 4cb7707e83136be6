"""Token ids in chunks of shuffled bit planes.

A chunk holds the ids of whole documents. Its ids are cut into blocks of a fixed size, each
block is transposed into bit planes (or byte planes), and the planes of one significance are
compressed together with zstandard. Chunks are rows of a table that Spark writes (so a lost
task leaves no part behind), beside columns that serve as the index: the shard, the place in
it, the first document, how many documents and ids, and how many ids of the shard come before.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.llm.chunks import library_encoder, slices
from goldweave.llm.tables import texts

BLOCK_IDS = 8192
CHUNK_IDS = 1 << 18
_HEAD = struct.Struct("<4sBBHIQ")  # mark, planes, bits per plane, free, block size, numbers
_MARK = b"BPL1"

CHUNKS = ("shard long, chunk long, first_doc long, n_docs long, n_ids long, start long, "
          "doc_ids binary, doc_tokens binary, ids binary")


def shuffle_planes(values: np.ndarray, bits: int = 1, block: int = BLOCK_IDS) -> bytes:
    """Unsigned integers as compressed planes of 1 or 8 bits.

    The last block may be short; with single bits a block's plane is padded to whole bytes.
    """
    if bits not in (1, 8):
        raise ValueError("planes have 1 or 8 bits")
    values = np.ascontiguousarray(values, values.dtype.newbyteorder("<"))
    width = values.dtype.itemsize
    planes = width * 8 // bits
    out: list[list[bytes]] = [[] for _ in range(planes)]
    for at in range(0, len(values), block):
        by_byte = values[at:at + block].view(np.uint8).reshape(-1, width)
        if bits == 8:
            rows = np.ascontiguousarray(by_byte.T)
        else:
            rows = np.packbits(np.unpackbits(by_byte, axis=1, bitorder="little").T, axis=1)
        for plane, row in zip(out, rows, strict=True):
            plane.append(row.tobytes())
    packer = zstandard.ZstdCompressor(level=3)
    packed = [packer.compress(b"".join(plane)) for plane in out]
    head = _HEAD.pack(_MARK, planes, bits, 0, block, len(values))
    return head + struct.pack(f"<{planes}I", *map(len, packed)) + b"".join(packed)


def restore_planes(data: bytes) -> np.ndarray:
    """The integers that :func:`shuffle_planes` was given."""
    mark, planes, bits, _, block, n = _HEAD.unpack_from(data)
    if mark != _MARK:
        raise ValueError("not a chunk of bit planes")
    sizes = struct.unpack_from(f"<{planes}I", data, _HEAD.size)
    at = _HEAD.size + 4 * planes
    unpacker = zstandard.ZstdDecompressor()
    raw = []
    for size in sizes:
        raw.append(np.frombuffer(unpacker.decompress(data[at:at + size]) if n else b"", np.uint8))
        at += size
    width = planes * bits // 8
    out = np.empty((n, width), np.uint8)
    done = 0
    for first in range(0, n, block):
        m = min(block, n - first)
        step = m if bits == 8 else (m + 7) // 8
        rows = np.stack([r[done:done + step] for r in raw])
        done += step
        if bits == 8:
            out[first:first + m] = rows.T
        else:
            cells = np.unpackbits(rows, axis=1, count=m)
            out[first:first + m] = np.packbits(cells.T, axis=1, bitorder="little")
    return out.reshape(-1).view(f"<u{width}")


def write_tokens(rows: DataFrame, path: str, tokenizer: str, spaces: str | None = None, end_id: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text", bits: int = 8,
                 chunk_ids: int = CHUNK_IDS) -> None:
    """Encode every text, append ``end_id``, and write chunks in ascending order of the id.

    Rows are dealt to shards by ranges of (id, text hash) and sorted within, so a shard holds
    consecutive documents and equal ids do not meet in one task. A chunk ends after the
    document with which it reaches ``chunk_ids`` ids; a longer document is a chunk of its own.
    The id must be an integer; rows with a null id come first. A null or empty text has only
    its end id. Repeated rows are all written. An empty table writes a table without rows.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        texts(rows, id_col, text_col)
        .select(F.col("id").cast("long").alias("id"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(parts, F.col("id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
        .select(F.spark_partition_id().cast("long").alias("shard"), "id", "text")
    )
    names = [f.split()[0] for f in CHUNKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, spaces)
        held: list[tuple[int | None, np.ndarray]] = []
        size = chunk = start = 0
        shard = 0

        def flush() -> pa.RecordBatch:
            # A null id is kept as a flag in the lowest bit.
            doc_ids = np.array([0 if d is None else d for d, _ in held], np.int64)
            known = np.array([d is not None for d, _ in held], np.uint64)
            row = {
                "shard": shard, "chunk": chunk, "first_doc": held[0][0], "n_docs": len(held),
                "n_ids": size, "start": start,
                "doc_ids": shuffle_planes(
                    np.concatenate([doc_ids.view(np.uint64), known]), 8),
                "doc_tokens": shuffle_planes(
                    np.array([len(x) for _, x in held], np.uint64), 8),
                "ids": shuffle_planes(np.concatenate([x for _, x in held]), bits),
            }
            return pa.RecordBatch.from_arrays(
                [pa.array([row[n]], pa.binary() if isinstance(row[n], bytes) else pa.int64())
                 for n in names], names=names)

        for batch in batches:
            if batch.num_rows:
                shard = batch.column(0)[0].as_py()
            for first, column in slices(batch.column(2)):
                ids, counts = encoder.ids(column)
                ends = np.cumsum(counts)
                if end_id is not None:
                    ids = np.insert(ids, ends, end_id)
                    counts, ends = counts + 1, ends + np.arange(1, len(ends) + 1)
                docs = batch.column(1).slice(first, len(column)).to_pylist()
                for doc, end, n in zip(docs, ends.tolist(), counts.tolist(), strict=True):
                    held.append((doc, ids[end - n:end]))
                    size += n
                    if size >= chunk_ids:
                        yield flush()
                        held, chunk, start, size = [], chunk + 1, start + size, 0
        if held:
            yield flush()

    ordered.mapInArrow(run, CHUNKS).write.option("compression", "none").parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of the chunks, with ``start`` counted over all shards.

    Totals of shards (one row per writing task) are summed up in order of the shard.
    """
    from pyspark.sql import Window

    index = spark.read.schema(CHUNKS).parquet(path).drop("doc_ids", "doc_tokens", "ids")
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("shard", F.coalesce(before, F.lit(0)).alias("offset"))
    return index.join(offsets, "shard").withColumn("start", F.col("start") + F.col("offset")) \
        .drop("offset")


def read_tokens(spark: SparkSession, path: str, digest: bool = False,
                id_col: str = "doc_id") -> DataFrame:
    """The id, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` as binary.

    With ``digest`` the crc of the ids stands in place of the ids.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path).select(
        "shard", "chunk", "doc_ids", "doc_tokens", "ids")
    placed = chunks.join(chunk_index(spark, path).select("shard", "chunk", "start"),
                         ["shard", "chunk"]).select("start", "doc_ids", "doc_tokens", "ids")
    last = "ids_crc32 long" if digest else "ids binary"

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                first, doc_ids, doc_tokens, ids = (batch.column(k)[r].as_py() for k in range(4))
                both = restore_planes(doc_ids)
                n = len(both) // 2
                docs, known = both[:n].astype(np.uint64).view(np.int64), both[n:] == 1
                counts = restore_planes(doc_tokens).astype(np.int64)
                values = restore_planes(ids)
                ends = np.cumsum(counts)
                own = [values[e - k:e].tobytes() for e, k in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=~known), pa.array(first + ends - counts),
                     pa.array(counts),
                     pa.array([zlib.crc32(x) for x in own], pa.int64()) if digest
                     else pa.array(own, pa.binary())],
                    names=[id_col, "start", "n_tokens", last.split()[0]])

    return placed.mapInArrow(run, f"{id_col} long, start long, n_tokens long, {last}")
