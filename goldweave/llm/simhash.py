"""Near duplicates by SimHash, with pairs of close fingerprints found by vantage-point trees.

A node of a tree holds a fingerprint and a radius: what lies within it goes inside, the rest
outside. Two fingerprints at most ``r`` bits apart differ by at most ``r`` in their distance to
any vantage point, so one that lives outside has to be looked up inside only if it is at most
``r`` beyond the radius; one that is a guest already is turned away from a branch by the same
bound. The top of the tree, fitted on a bounded sample, deals all fingerprints into shards, each
to the shard it lives in and, as a guest, to those its ball overlaps. A shard grows the rest of the
tree from its own fingerprints and finds its pairs exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.llm.chunks import slices
from goldweave.llm.components import components
from goldweave.llm.tables import id_type, schema, texts
from goldweave.operators.joins import join_unique
from goldweave.session import staged

SLICE_BYTES = 4 << 20
SEED = 42
# The sample for the top of the tree: at most so many fingerprints, 2 MB, on the driver.
SAMPLE = 1 << 18
# Fingerprints that live in a shard, as long as the sample can tell so many shards apart.
SHARD = 1 << 12
SAMPLE_PER_SHARD = 32
LEAF = 512
# Fingerprints compared at once, and pairs kept before they are folded.
BLOCK = 1 << 12
PAIRS = 1 << 20

_LANES = np.uint64(0x0101010101010101)


# --- fingerprints -----------------------------------------------------------------


def fingerprints_of(words: list[list[bytes]], n: int = 3) -> np.ndarray:
    """The fingerprint of each list of words: bits set in over half the hashes of its shingles."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros(len(words), np.uint64)
    flat = [w for ws in words for w in ws]
    if not flat:
        return out
    joined = b" ".join(flat)
    ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    # A text with fewer than n words is one shingle.
    width = np.minimum(sizes, n)
    counts = np.where(sizes > 0, sizes - width + 1, 0)
    base = np.repeat(np.cumsum(sizes) - sizes, counts)
    place = np.cumsum(counts)
    first = base + np.arange(len(base)) - np.repeat(place - counts, counts)
    last = first + np.repeat(width, counts) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)],
        np.uint64, len(first))
    held = np.flatnonzero(counts)
    out[held] = _majority(hashes, counts[held])
    return out


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits set in over half of each group of consecutive hashes.

    Eight bits, a byte apart, are added in one number; a part of at most 255 hashes fills a byte.
    """
    parts = (counts + 254) // 255
    ends = np.cumsum(parts)
    nth = np.arange(ends[-1]) - np.repeat(ends - parts, parts)
    starts = np.repeat(np.cumsum(counts) - counts, parts) + 255 * nth
    sums = np.empty((len(starts), 8, 8), np.uint8)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        sums[:, :, bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.add.reduceat(sums.reshape(-1, 64), ends - parts, axis=0, dtype=np.int64)
    bits = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprints(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """The id and ``fp``, the fingerprint as a signed 64-bit number.

    Letters A to Z are lowered, words stand between ASCII white space, shingles have ``n`` words
    and repeats count. A null or empty text, or one of white space, has fingerprint 0.
    """
    out = schema(id_type(rows, id_col), "fp long", id_col)

    def run(batches):
        for batch in batches:
            for start, column in slices(batch.column(1).cast(pa.binary()), SLICE_BYTES):
                found = fingerprints_of([t.lower().split() for t in column.to_pylist()], n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(column)), pa.array(found.view(np.int64))],
                    names=out.names)

    return texts(rows, id_col, text_col).mapInArrow(run, out)


# --- trees ------------------------------------------------------------------------


@dataclass
class Node:
    """A vantage point and its branches; a leaf has a number instead."""

    leaf: int = -1
    point: np.uint64 = np.uint64(0)
    radius: int = 0
    inside: "Node | None" = None
    outside: "Node | None" = None


def _distance(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point).astype(np.int64)


def split(points: np.ndarray, reach: int) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that part the points with few in reach of both sides.

    None if no distance parts them. Decided on up to 1,024 of the points, so only the shape of a
    tree depends on it.
    """
    some = points[:: max(1, len(points) // 1024)]
    best = None
    for point in some[:: max(1, len(some) // 8)][:8]:
        below = np.cumsum(np.bincount(_distance(some, point), minlength=65 + reach)) / len(some)
        share = np.clip(below[:65], 1e-9, 1 - 1e-9)
        bits = -(share * np.log2(share) + (1 - share) * np.log2(1 - share))
        guests = below[reach:reach + 65] - below[:65]
        # Guests per bit of order gained.
        cost = np.where((share > 0.1) & (share < 0.9), (guests + 0.01) / bits, np.inf)
        radius = int(np.argmin(cost))
        if np.isfinite(cost[radius]) and (best is None or cost[radius] < best[0]):
            best = (cost[radius], point, radius)
    return best and best[1:]


def branches(node_point: np.uint64, radius: int, home: np.ndarray, guests: np.ndarray, reach: int):
    """What goes inside and outside: masks of home, and masks of the guests each branch gets.

    A pair across the radius is found inside, where its outer member is a guest.
    """
    d, g = _distance(home, node_point), _distance(guests, node_point)
    return d <= radius, (d > radius) & (d <= radius + reach), g <= radius + reach, g > radius - reach


def fit(sample: np.ndarray, leaf_size: float, reach: int) -> tuple[Node, int]:
    """A tree whose leaves hold at most about ``leaf_size`` of the sample, and their number."""
    leaves = 0

    def grow(points: np.ndarray) -> Node:
        nonlocal leaves
        parted = split(points, reach) if len(points) > leaf_size else None
        if parted is None:
            leaves += 1
            return Node(leaf=leaves - 1)
        point, radius = parted
        inside = _distance(points, point) <= radius
        return Node(point=point, radius=radius, inside=grow(points[inside]), outside=grow(points[~inside]))

    return grow(np.sort(sample)), leaves


def deal(tree: Node, points: np.ndarray, reach: int):
    """(leaf, indices of points that live there, indices of guests) for every leaf that gets some."""
    stack = [(tree, np.arange(len(points)), np.zeros(0, np.int64))]
    while stack:
        node, home, guests = stack.pop()
        if not len(home) and not len(guests):
            continue
        if node.leaf >= 0:
            yield node.leaf, home, guests
            continue
        inner, near, g_in, g_out = branches(
            node.point, node.radius, points[home], points[guests], reach)
        stack.append((node.inside, home[inner], np.concatenate([guests[g_in], home[near]])))
        stack.append((node.outside, home[~inner], guests[g_out]))


def close_pairs(points: np.ndarray, home: np.ndarray, guests: np.ndarray, reach: int):
    """Blocks of index pairs of points at most ``reach`` bits apart, one of each at home."""
    stack = [(home, guests)]
    while stack:
        home, guests = stack.pop()
        if not len(home):
            continue
        parted = split(points[home], reach) if len(home) > LEAF else None
        if parted is None:
            every = np.concatenate([home, guests])
            for a in range(0, len(home), LEAF):
                # Each pair at home once, and every guest.
                for b in range(a, len(every), BLOCK):
                    x, y = home[a:a + LEAF], every[b:b + BLOCK]
                    near = np.bitwise_count(points[x][:, None] ^ points[y][None, :]) <= reach
                    i, j = np.nonzero(near)
                    later = b + j > a + i
                    yield x[i[later]], y[j[later]]
            continue
        inner, near, g_in, g_out = branches(*parted, points[home], points[guests], reach)
        stack.append((home[inner], np.concatenate([guests[g_in], home[near]])))
        stack.append((home[~inner], guests[g_out]))


def fold(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a[k]`` and ``b[k]``; ``roots`` points each index to the least of its set."""
    while len(a):
        a, b = roots[a], roots[b]
        open_ = a != b
        a, b = a[open_], b[open_]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots[:] = up


def forest(points: np.ndarray, home: np.ndarray, guests: np.ndarray, reach: int) -> np.ndarray:
    """For each index the least index it is linked to through pairs found here."""
    roots = np.arange(len(points))
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for a, b in close_pairs(points, home, guests, reach):
        kept.append((a, b))
        held += len(a)
        if held > PAIRS:
            fold(roots, *map(np.concatenate, zip(*kept, strict=True)))
            kept, held = [], 0
    if kept:
        fold(roots, *map(np.concatenate, zip(*kept, strict=True)))
    return roots


# --- the join ---------------------------------------------------------------------


def links(nodes: DataFrame, reach: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` that connect just what close fingerprints ``fp`` connect.

    ``nodes`` holds each fingerprint once. A shard gives at most one edge per fingerprint it saw.
    """
    spark = nodes.sparkSession
    n = nodes.count()
    some = nodes
    if n > SAMPLE:
        step = 1 << 30
        some = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(step)) < int(step * SAMPLE / n * 0.98))
    sample = np.array([r.fp for r in some.select("fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    per_leaf = max(SAMPLE_PER_SHARD, SHARD * len(sample) / max(n, 1))
    tree, shards = fit(sample, per_leaf, reach)

    def assign(batches):
        for batch in batches:
            values = batch.column(0).to_numpy()
            for leaf, home, guests in deal(tree, values.view(np.uint64), reach):
                at = np.concatenate([home, guests])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), leaf)), pa.array(values[at]),
                     pa.array(np.arange(len(at)) < len(home))], names=["shard", "fp", "home"])

    def join(rows: pa.Table) -> pa.Table:
        values = rows.column("fp").to_numpy()
        order = np.argsort(values)
        values, at_home = values[order], rows.column("home").to_numpy()[order]
        roots = forest(values.view(np.uint64), np.flatnonzero(at_home), np.flatnonzero(~at_home), reach)
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.table({"a": values[moved], "b": values[roots[moved]]})

    dealt = nodes.select("fp").mapInArrow(assign, "shard long, fp long, home boolean")
    parts = max(1, min(shards, int(math.ceil(4 * n / SHARD))))
    return dealt.repartition(parts, "shard").groupBy("shard").applyInArrow(join, "a long, b long")


def near_duplicates(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3,
                    reach: int = 2) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are linked if their fingerprints differ in at most ``reach`` bits; ``component_id`` is
    the smallest id that links lead to. Texts with one fingerprint are one node, however many.

    Null and empty texts, and texts of white space, share fingerprint 0, which links like any
    other. A null id takes no part in the smallest id, and ``component_id`` is null where all ids
    are. Equal ids and repeated rows are kept; an empty table gives an empty one; other columns
    are left out.
    """
    prints = staged(fingerprints(rows, id_col, text_col, n).toDF("id", "fp"), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-nodes")
    tied = components(staged(links(nodes, reach), "fingerprint-links"), "fingerprint-components")
    tied = tied.select(F.col("node").alias("fp"), "root").distinct()
    named = tied.join(nodes, "fp").select("fp", "root", "least")
    # A component may hold a great many fingerprints: its rows are split in this join.
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = join_unique(named.select("fp", "root"), least, ["root"], "inner").select("fp", "component_id")
    every = nodes.join(labels, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"))
    # So may a fingerprint hold a great many rows.
    return join_unique(prints, every, ["fp"], "inner").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
