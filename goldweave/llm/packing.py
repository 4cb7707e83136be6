"""Packing documents into training sequences, lexically similar ones together."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldweave.llm.chunks import library_encoder, slices
from goldweave.llm.tables import id_type, schema, texts
from goldweave.operators.joins import join_unique
from goldweave.session import scratch

LENGTH = 2048
SHARD_TOKENS = 4 << 20
#: Keys are dealt into buckets, this many to a shard on average, and runs of so many buckets are
#: cut into shards by themselves. A table of up to MAX_BROADCAST buckets is broadcast.
BUCKETS_PER_SHARD = 8
RUN_BITS = 12
MAX_BROADCAST = 1 << 16
#: Terms in more than this share of a shard's documents are kept as rows of weights by document.
DENSE = 1 / 8
NEIGHBOURS = 64
#: Weights that are added to scores at once.
BLOCK = 1 << 18
# Fixed parameters of the ranking function.
K1, B = 1.2, 0.75


class Bm25:
    """An inverted index over the token ids of the documents of one shard."""

    def __init__(self, docs: list[np.ndarray]):
        # Terms with their documents as one sorted sequence of numbers.
        n = len(docs)
        flat = np.concatenate(docs)
        sizes = np.fromiter(map(len, docs), np.int64, n)
        held = flat.astype(np.uint64) << np.uint64(32)
        held |= np.repeat(np.arange(n, dtype=np.uint32), sizes)
        held.sort()
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        count = np.diff(first, append=len(held))
        held = held[first]
        self.owner = held.astype(np.uint32).astype(np.int32)
        term = (held >> np.uint64(32)).astype(flat.dtype)
        self.starts = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.terms = term[self.starts]
        self.ends = np.append(self.starts[1:], len(term))
        df = self.ends - self.starts
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
        size = sizes.astype(np.float32)
        norm = K1 * (1 - B + B * size / max(float(size.mean()), 1.0))
        tf = count.astype(np.float32)
        self.weight = np.repeat(self.idf, df) * tf * (K1 + 1) / (tf + norm[self.owner])
        # The terms of each document that another document has as well.
        shared = np.repeat(df > 1, df)
        held = self.owner[shared].astype(np.uint64) << np.uint64(32)
        held |= np.repeat(np.arange(len(df), dtype=np.uint32), np.where(df > 1, df, 0))
        held.sort()
        at = held.astype(np.uint32).astype(np.int32)
        ends = np.cumsum(np.bincount(self.owner[shared], minlength=n)).tolist()
        self.queries = [at[i:j] for i, j in zip([0, *ends], ends, strict=False)]
        common = np.flatnonzero(df > max(DENSE * n, 1))
        self.row = np.full(len(df), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), n), np.float32)
        for row, at in zip(self.rows, common, strict=True):
            part = slice(self.starts[at], self.ends[at])
            row[self.owner[part]] = self.weight[part]
        self.scores = np.zeros(n, np.float32)
        self.scored = -1

    def score(self, seed: int) -> None:
        """The scores of all documents by every term of the seed, kept until another is asked for."""
        if seed == self.scored:
            return
        self.scored = seed
        self.scores[:] = 0
        at = self.queries[seed]
        row = self.row[at]
        rows = row[row >= 0]
        # One after another in either way, so that sums do not depend on how many are taken at once.
        step = max(1, BLOCK // len(self.scores))
        for k in range(0, len(rows), step):
            own = rows[k:k + step]
            both = np.empty((len(own) + 1, len(self.scores)), np.float32)
            both[0] = self.scores
            np.take(self.rows, own, axis=0, out=both[1:], mode="clip")
            np.add.reduce(both, axis=0, out=self.scores)
        rare = at[row < 0]
        sizes = self.ends[rare] - self.starts[rare]
        ends = np.cumsum(sizes)
        k = 0
        while k < len(rare):
            done = ends[k] - sizes[k]
            stop = max(k + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
            own = sizes[k:stop]
            part = np.arange(done, ends[stop - 1]) + np.repeat(self.starts[rare[k:stop]] - ends[k:stop] + own, own)
            np.add.at(self.scores, self.owner[part], self.weight[part])
            k = stop

    def neighbours(self, seed: int, unused: np.ndarray, want: int = NEIGHBOURS) -> np.ndarray:
        """Unused documents by falling score; those without a shared term are left out.

        The best ``want`` of them: it is asked again once these are used.
        """
        if not len(self.queries[seed]):
            return np.zeros(0, np.int64)
        self.score(seed)
        hit = np.flatnonzero((self.scores > 0) & unused)
        if len(hit) > want:
            hit = hit[np.argpartition(-self.scores[hit], want)[:want]]
        return hit[np.lexsort((hit, -self.scores[hit]))]


def order_by_retrieval(docs: list[np.ndarray], length: int, ends: int = 0) -> list[int]:
    """All documents in the order in which they fill windows.

    The last ``ends`` ids of each take up place but are not searched by.

    A seed opens a window and its best unused neighbours fill it; the document that reaches
    over the end of the window is the seed of the next one. Without a neighbour left, the
    next unused document follows. Documents without an id to search by come last.
    """
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    if (sizes == ends).any():
        rest = np.flatnonzero(sizes > ends)
        inner = order_by_retrieval([docs[i] for i in rest], length, ends) if len(rest) else []
        return [*rest[inner].tolist(), *np.flatnonzero(sizes == ends).tolist()]
    index = Bm25([d[:len(d) - ends] for d in docs])
    usual = float(sizes.mean()) if len(docs) else 1.0
    unused = np.ones(len(docs), bool)
    order: list[int] = []
    at = following = 0  # ids placed so far

    def place(i: int) -> None:
        nonlocal at
        order.append(i)
        unused[i] = False
        at += len(docs[i])

    while len(order) < len(docs):
        if not order:
            place(0)
        seed = order[-1]
        end = (at // length + 1) * length
        while at < end and len(order) < len(docs):
            best = index.neighbours(seed, unused, max(NEIGHBOURS, int((end - at) / usual)))
            for i in best:
                place(int(i))
                if at >= end:
                    break
            if not len(best):
                while not unused[following]:
                    following += 1
                place(following)
                if at < end:
                    seed = following
    return order


def pack(rows: DataFrame, tokenizer: str, end_id: int, spaces: str = "kept", length: int = LENGTH,
         shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece of a document: where it starts and which place of which sequence it has.

    Columns: the id, ``start`` and ``length`` (in the document's ids, ``end_id`` included),
    ``ids`` of the piece (binary, little-endian), ``doc_tokens``, ``sequence_id`` and
    ``offset``. Sequences have ``length`` ids, but for the last of each shard.

    Documents are encoded once and written. They are then dealt by a lexical key (the smallest hash
    of a pair of ids), so that similar ones meet, into shards of ``shard_tokens`` to twice as many
    ids: buckets of keys, taken together while they fill a shard; the documents of a bucket that
    fills several, as of many copies, are dealt by their id and text. So the shards depend on the
    documents alone. A task holds one shard at a time, with an index of its own.

    A null or empty text is its end id. Null ids, equal ids and repeated rows are packed like
    any other row; an empty table gives an empty one; other columns are left out.
    """
    spark = rows.sparkSession
    kind = id_type(rows, id_col)
    path = scratch(spark, "packing")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, spaces)
        factor = np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for first, column in slices(batch.column(1)):
                flat, counts = encoder.ids(column)
                ends = np.cumsum(counts)
                ids = np.insert(flat, ends, end_id)
                counts, ends = counts + 1, ends + np.arange(1, len(ends) + 1)
                with np.errstate(over="ignore"):
                    pair = (ids[:-1].astype(np.uint64) << np.uint64(32)) | ids[1:]
                    pair = ((pair ^ (pair >> np.uint64(29))) * factor) >> np.uint64(33)
                # Pairs within a document; the last one of each reaches into the next.
                pair = np.append(pair, np.uint64(0))
                pair[ends - 1] = np.uint64(1 << 31)
                keys = np.minimum.reduceat(pair, ends - counts).astype(np.int64)
                stored = ids.astype("<u2" if ids.max() < 1 << 16 else "<u4")
                width = stored.itemsize
                values = pa.Array.from_buffers(
                    pa.large_binary(), len(ends),
                    [None, pa.py_buffer(np.append(0, ends * width).astype(np.int64).tobytes()),
                     pa.py_buffer(stored.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(column)), pa.array(keys),
                     batch.column(2).slice(first, len(column)),
                     pa.array(counts), values.cast(pa.binary())],
                    names=["id", "key", "tie", "n", "packed"])

    texts(rows, id_col, text_col).withColumn("tie", F.xxhash64("text")).mapInArrow(
        encode, schema(kind, "key long, tie long, n long, packed binary")) \
        .write.option("compression", "zstd").parquet(path)
    encoded = spark.read.schema(schema(kind, "key long, tie long, n long, packed binary")).parquet(path)
    total = encoded.agg(F.sum("n")).first()[0] or 0
    out = schema(kind, "start long, length long, ids binary, doc_tokens long, sequence_id long, "
                 "offset long", id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        shard = None

        def packed_shard() -> pa.RecordBatch:
            sequence = shard << 26
            docs = [ids for _, ids in held]
            columns: list[list] = [[] for _ in out.names]
            at = 0
            for i in order_by_retrieval(docs, length, ends=1):
                ids, done = docs[i], 0
                while done < len(ids):
                    n = min(len(ids) - done, length - at % length)
                    for c, v in zip(columns, (
                            held[i][0], done, n, ids[done:done + n].astype("<u4").tobytes(), len(ids),
                            sequence + at // length, at % length), strict=True):
                        c.append(v)
                    at += n
                    done += n
            n = pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    columns, [id_arrow, n, n, pa.binary(), n, n, n], strict=True)], names=out.names)

        id_arrow = pa.int64()
        for batch in batches:
            id_arrow = batch.column(0).type
            for doc, own, n, packed in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if own != shard and held:
                    yield packed_shard()
                    held = []
                shard = own
                held.append((doc, np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4")))
        if held:
            yield packed_shard()

    dealt = _sharded(encoded, total, shard_tokens)
    return dealt.repartition(total // shard_tokens + 1, "shard") \
        .sortWithinPartitions("shard", "place", "id", "tie") \
        .select("id", "shard", "n", "packed").mapInArrow(run, out)


def _sharded(encoded: DataFrame, total: int, shard_tokens: int) -> DataFrame:
    """Encoded documents with ``shard``, and ``place``, their order in it but for equal keys.

    A bucket is in the shard in which its first id falls if the buckets of its run are laid end to
    end. A bucket longer than a shard fills that and the following ones.
    """
    bits = min(30, max(0, math.ceil(math.log2(max(1, BUCKETS_PER_SHARD * total / shard_tokens)))))
    # Small keys are the most frequent: hashed, they are even.
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    placed = encoded.withColumn("place", place).withColumn("bucket", F.shiftright("place", 30 - bits))
    by_run = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("bucket").agg(F.sum("n").alias("held")).withColumn(
        "run", F.shiftright("bucket", RUN_BITS))
    first = F.coalesce(F.sum("held").over(by_run), F.lit(0))
    buckets = sizes.select(
        "bucket", F.expr(f"held div {shard_tokens} + 1").alias("times"),
        (F.shiftleft("run", 23) + F.floor(first / shard_tokens)).cast("long").alias("first"))
    if 1 << bits <= MAX_BROADCAST:
        joined = placed.join(F.broadcast(buckets), "bucket")
    else:
        joined = join_unique(placed, buckets, ["bucket"], "inner")
    own = F.pmod(F.xxhash64("id", "tie"), F.col("times"))
    return joined.withColumn("shard", F.col("first") + own)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
