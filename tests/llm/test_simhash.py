"""SimHash fingerprints and their components against all pairs."""

import numpy as np
import pytest
import xxhash

from goldweave.llm import simhash
from goldweave.llm.queries import op13_simhash_neardup


def fingerprint(text, n=3):
    words = bytes(text or "", "utf-8").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, reach=2):
    """The index of each fingerprint's component, by all pairs."""
    p = np.array(prints, np.uint64)
    label = np.arange(len(p))
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= reach
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def clustered(rng, n):
    p = rng.integers(0, 2**63, n, dtype=np.uint64)
    p[n // 3:] = p[rng.integers(0, n // 3, n - n // 3)]
    for _ in range(3):
        p ^= (rng.random(n) < 0.6).astype(np.uint64) << rng.integers(0, 64, n).astype(np.uint64)
    return np.unique(p)


def test_fingerprints():
    rng = np.random.default_rng(1)
    docs = [" ".join(f"W{i}" for i in rng.integers(0, 40, n)) for n in (0, 1, 2, 3, 4, 255, 256, 257, 258, 900)]
    docs += ["  a\tB\n c\x0bd ", "Éa é ÉA", "\xa0 x", "x " * 2000]
    found = simhash.fingerprints_of([d.encode().lower().split() for d in docs])
    assert found.tolist() == [fingerprint(d) for d in docs]


@pytest.mark.parametrize("leaf", [3, 40, 5000])
def test_trees_find_every_pair(monkeypatch, leaf):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "PAIRS", 50)
    p = clustered(np.random.default_rng(leaf), 1500)
    want = {(i, j) for i, j in np.argwhere(np.bitwise_count(p[:, None] ^ p[None, :]) <= 2) if i < j}
    none = np.zeros(0, np.int64)
    found = [tuple(sorted(x)) for a, b in simhash.close_pairs(p, np.arange(len(p)), none, 2)
             for x in zip(a.tolist(), b.tolist())]
    assert len(found) == len(set(found)) and set(found) == want
    assert simhash.forest(p, np.arange(len(p)), none, 2).tolist() == components(p).tolist()
    tree, leaves = simhash.fit(p[::2], 60, 2)
    assert leaves > 5
    dealt = list(simhash.deal(tree, p, 2))
    assert sorted(np.concatenate([home for _, home, _ in dealt]).tolist()) == list(range(len(p)))
    across = {tuple(sorted(x)) for _, home, guests in dealt
              for a, b in simhash.close_pairs(p, home, guests, 2) for x in zip(a.tolist(), b.tolist())}
    assert across == want


def test_points_that_no_distance_parts():
    p = np.array([1 << k for k in range(64)], np.uint64)
    found = simhash.forest(p, np.arange(64), np.zeros(0, np.int64), 2)
    assert found.tolist() == [0] * 64


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs, **options).collect()
    prints = sorted({fingerprint(r[1]) for r in rows})
    label = dict(zip(prints, components(prints).tolist(), strict=True))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[label[fingerprint(t)]] = min(i, least.get(label[fingerprint(t)], i))
    want = sorted(((i, f"{fingerprint(t):016x}", least.get(label[fingerprint(t)])) for i, t, _ in rows), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want
    return found


def test_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 20)
    monkeypatch.setattr(simhash, "SAMPLE_PER_SHARD", 5)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(9, None, "x"), (8, "", "x"), (7, " \n", "x"), (None, "only null ids here", "x"),
            (None, "the same text", "x"), (5, "The same  text", "x"), (5, "THE SAME TEXT", "x")]
    for k in range(60):
        base = [words[i] for i in rng.integers(0, 300, 120)]
        for _ in range(rng.integers(1, 6)):
            copy = list(base)
            for _ in range(rng.integers(0, 3)):
                copy[rng.integers(0, 120)] = words[rng.integers(0, 300)]
            rows.append((100 + len(rows), " ".join(copy), "x"))
    rows += [(5000 + k, "hot copy of one text", "x") for k in range(300)]
    found = check(spark, rows)
    assert len({r.component_id for r in found}) < len({r.fingerprint for r in found})
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted(tuple(r) for r in check(spark, rows))
    assert sorted(tuple(r) for r in op13_simhash_neardup(spark, folder).collect()) == want
