"""Near-duplicate texts: a join on the Jaccard similarity of word shingles.

MinHash signatures are cut into the labels of several trees. Texts that share a prefix of a
label are a node of that tree's trie. Prefixes are so short that a pair at the threshold is found
at the target rate by itself, and are shortened further while the links seen do not let expect
the target recall; then everything found is verified exactly.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.llm.components import components
from goldweave.llm.tables import id_type, schema, texts
from goldweave.session import scratch

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 6
TARGET_RECALL = 0.999
NODE_BLOCK = 1024
SET_BLOCK = 256

_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Hashes of words, kept for words seen before."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str], codes: dict[str, int], k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of k words; fewer words are one run."""
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter((codes[w] for w in words), np.uint64, len(words))
    k = min(k, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * _FACTOR + each[i:i + len(out)]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_601)
    a = draw.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, count, dtype=np.uint64)


def signature(found: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The upper halves of the smallest value of each hash function."""
    out = np.empty(len(functions[0]), np.uint32)
    with np.errstate(over="ignore"):
        for i, (a, b) in enumerate(zip(*functions, strict=True)):
            out[i] = (found * a + b).min() >> np.uint64(32)
    return out


def found_rate(similarity, depth: int, trees: int = TREES):
    """Probability that two texts share a prefix of this depth in one tree or more."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** trees


def first_depth(threshold: float, trees: int, target: float) -> tuple[int, int]:
    """The longest prefix that finds a pair at the threshold at the target rate, and the trees.

    There are more trees than asked for if even the shortest prefix falls short.
    """
    if not (0 < threshold <= 1 and target < 1):
        raise ValueError("the threshold must be in (0, 1] and the target below 1")
    while found_rate(threshold, 1, trees) < target:
        trees += 1
    return max(d for d in range(1, DEPTH + 1) if found_rate(threshold, d, trees) >= target), trees


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
    """Rows of sorted batches, by their first columns."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return itertools.groupby(rows, key=lambda r: r[:keys])


def _local_roots(n: int, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest index of each component of a small graph."""
    root = np.arange(n)
    a, b = pairs
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def overlaps(sets: list[np.ndarray], step: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, over slices of their values."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    keep = times[place] > 1
    owner, column = owner[keep], shared[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((n, n), np.float32)
    for first in range(0, int(shared[-1]) + 1 if len(values) else 0, step):
        lo, hi = np.searchsorted(column, [first, first + step])
        cells = np.zeros((n, step), np.float32)
        cells[owner[lo:hi], column[lo:hi] - first] = 1
        out += cells @ cells.T
    return out.astype(np.int64)


def _blocks(members: DataFrame, key: str, block: int) -> DataFrame:
    """Members in pairs of blocks of their group: columns ``i``, ``j`` and ``mine``.

    A group of n members has about n / block blocks; each member is in as many pairs of
    blocks. A group that fits in one block is one pair, and its members are not repeated.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("size")).where(F.col("size") > 1) \
        .select(key, F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    placed = members.join(sizes, key).withColumn(
        "mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.select("*", other.alias("other")).select(
        *placed.columns, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def _tested(mine: np.ndarray, i: int, j: int) -> np.ndarray:
    """Which pairs of members belong to this pair of blocks, upper triangle only."""
    n = len(mine)
    upper = np.triu(np.ones((n, n), bool), 1)
    return upper if i == j else upper & (mine[:, None] != mine[None, :])


def _linked(nodes: DataFrame, depth: int, trees: int, threshold: float) -> DataFrame:
    """Edges between texts that share a node and whose signatures agree enough.

    A pair of blocks gives one edge per member at most, and what the recall estimate needs:
    the pairs seen first in this tree, and the number of pairs that they stand for.
    """
    # Five standard deviations below the threshold: one true pair in millions falls short.
    values = trees * DEPTH
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, tree, i, j), rows in _grouped(batches, 4):
            rows = list(rows)
            signs = np.frombuffer(b"".join(r[6] for r in rows), "<u4").reshape(len(rows), values)
            mine = np.array([r[4] for r in rows])
            n = len(rows)
            a, b = np.nonzero(_tested(mine, i, j))
            agree = np.concatenate([
                (signs[a[k:k + 65536]] == signs[b[k:k + 65536]]).mean(axis=1)
                for k in range(0, len(a), 65536)] or [np.zeros(0)])
            a, b, agree = a[agree >= least], b[agree >= least], agree[agree >= least]
            root = _local_roots(n, (a, b))
            mine_first = np.ones(len(a), bool)
            labels = signs.reshape(n, trees, DEPTH)[:, :, :depth]
            for t in range(tree):
                mine_first &= ~(labels[a, t] == labels[b, t]).all(axis=1)
            like = agree[mine_first & (agree >= threshold)]
            away = np.flatnonzero(root != np.arange(n))
            out_a = [rows[k][5] for k in away] + [None]
            out_b = [rows[root[k]][5] for k in away] + [None]
            seen = [0.0] * len(away) + [float(len(like))]
            stand = [0.0] * len(away) + [float((1 / found_rate(like, depth, trees)).sum())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary()), pa.array(seen),
                 pa.array(stand)], names=["a", "b", "seen", "stand"])

    label = F.col("signature").substr(F.col("tree") * 4 * DEPTH + 1, F.lit(4 * depth))
    members = nodes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))) \
        .select(F.xxhash64("tree", label).alias("key"), "tree", "node")
    placed = _blocks(members, "key", NODE_BLOCK).select("key", "tree", "i", "j", "mine", "node")
    whole = placed.join(nodes, "node").select("key", "tree", "i", "j", "mine", "node", "signature")
    return whole.repartition("key", "i", "j").sortWithinPartitions("key", "tree", "i", "j") \
        .mapInArrow(run, "a binary, b binary, seen double, stand double")


def _verified(members: DataFrame, threshold: float, k: int) -> DataFrame:
    """Exact links within clusters: per text and pair of blocks, its links and one edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for (_, i, j), rows in _grouped(batches, 3):
            rows = list(rows)
            sets = [shingles(words_of(r[6]), codes, k) for r in rows]
            sizes = np.array([len(s) for s in sets])
            shared = overlaps(sets)
            like = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
            like &= _tested(np.array([r[3] for r in rows]), i, j)
            a, b = np.nonzero(like)
            root = _local_roots(len(rows), (a, b))
            copies = np.array([r[5] for r in rows], np.int64)
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[x][4] for x in at], pa.binary()),
                 pa.array([rows[root[x]][4] for x in at], pa.binary()), pa.array(links[at])],
                names=["a", "b", "links"])

    placed = _blocks(members, "cluster", SET_BLOCK)
    return placed.select("cluster", "i", "j", "mine", "node", "copies", "text") \
        .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j") \
        .mapInArrow(run, "a binary, b binary, links long")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE_WORDS,
                    trees: int = TREES, target: float = TARGET_RECALL, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``class_id``, ``copy_id`` and ``n_links``.

    Words are runs of letters, digits and underscores in lower case. Texts with the same words
    in the same order are copies and are compared once; ``copy_id`` is the smallest id among
    them. Two texts are linked if the Jaccard similarity of their sets of k-word shingles is at
    least ``threshold``; ``n_links`` counts the other rows that a row is a copy of or linked
    to. ``class_id`` is the smallest id among all rows that are connected by links.

    Candidates are joined into clusters, and within a cluster every pair is verified on the
    texts, block by block; pairs are counted where they are found and never listed. A text of
    fewer than k words has one shingle. A null text or one without words is linked to nothing
    and keeps its own id. Null ids are passed over when the smallest id is sought. Repeated
    rows are copies. An empty table gives an empty one; other columns are left out.
    """
    spark = rows.sparkSession
    kind = id_type(rows, id_col)
    source = texts(rows, id_col, text_col)
    start, trees = first_depth(threshold, trees, target)
    values = trees * DEPTH

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, functions = _Codes(), _functions(values)
        for batch in batches:
            nodes: list[bytes | None] = []
            signs: list[bytes | None] = []
            for value in batch.column(1):
                words = words_of(value.as_py())
                nodes.append(xxhash.xxh3_128_digest(" ".join(words)) if words else None)
                signs.append(signature(shingles(words, codes, k), functions).astype("<u4").tobytes()
                             if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes, pa.binary()),
                 pa.array(signs, pa.binary())], names=["id", "tie", "node", "signature"])

    path = scratch(spark, "signatures")
    source.withColumn("tie", F.xxhash64("text")).mapInArrow(
        signed, schema(kind, "tie long, node binary, signature binary")).write.parquet(path)
    every = spark.read.parquet(path)
    classes = every.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("id").alias("copy_id"), F.count("*").alias("copies"),
        F.first("signature").alias("signature"))
    nodes = classes.select("node", "signature")

    for depth in range(start, 0, -1):
        path = scratch(spark, "candidates")
        _linked(nodes, depth, trees, threshold).write.parquet(path)
        found = spark.read.parquet(path)
        seen, stand = found.agg(F.sum("seen"), F.sum("stand")).first()
        if (seen or 0) >= target * (stand or 0):
            break
    edges = found.where(F.col("a").isNotNull()).select("a", "b")
    clusters = components(edges, "clusters").select("node", F.col("root").alias("cluster"))

    # The text of one member of each class that is in a cluster, found by id and text hash.
    chosen = every.join(clusters, "node").groupBy("node", "cluster").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "tie")).alias("at")) \
        .select("node", "cluster", "copies", F.col("at.id").alias("at"), F.col("at.tie").alias("tie"))
    body = source.select("id", "text", F.xxhash64("text").alias("tie"))
    members = chosen.join(body, (chosen["tie"] == body["tie"]) & chosen["at"].eqNullSafe(body["id"])) \
        .groupBy("node", "cluster", "copies").agg(F.first("text").alias("text"))
    path = scratch(spark, "links")
    _verified(members, threshold, k).write.parquet(path)
    links = spark.read.parquet(path)
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(links.select("a", "b"), "classes")

    info = classes.select("node", "copy_id", "copies").join(counts, "node", "left") \
        .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = info.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    per_node = info.join(least, "root").select(
        "node", "class_id", "copy_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return every.select("id", "node").join(per_node, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
