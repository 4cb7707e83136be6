"""Packing: every id once, no holes, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers

from goldweave.llm import packing

TEXTS = ["", None, "a b c", "a b c", "x " * 900, *[f"topic {i % 7} words {i} of the topic {i % 7} " * (i % 40)
                                                    for i in range(120)]]


def test_pieces_make_up_all_documents(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    pieces = packing.pack(table, path, end_id=1, length=64, shard_tokens=4000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    encoded = Tokenizer.from_file(path).encode_batch([t or "" for t in TEXTS], add_special_tokens=False)
    for i, e in enumerate(encoded):
        own = sorted(by_doc[i], key=lambda p: p.start)
        ids = [x for p in own for x in np.frombuffer(p.ids, "<u4").tolist()]
        assert ids == e.ids + [1]
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    short = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        short += sum(p.length for p in own) < 64
    assert short <= 12 and max(sum(p.length for p in own) for own in by_sequence.values()) == 64
    digests = packing.digest(packing.pack(table, path, end_id=1)).collect()
    assert all("ids" not in r.asDict() for r in digests)
    assert zlib.crc32(np.array([1], "<u4").tobytes()) in {r.ids_crc32 for r in digests}


def test_repeated_rows_and_empty_tables(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    table = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert packing.pack(table, path, end_id=1).count() == 3
    assert packing.pack(table.limit(0), path, end_id=1).count() == 0


def test_neighbours_share_terms():
    docs = [np.array(x, np.uint32) for x in ([1, 2, 3], [9, 8, 7], [1, 2, 4], [9, 8, 5], [6, 6, 6])]
    assert packing.order_by_retrieval(docs, 6)[:2] == [0, 2]
    assert sorted(packing.order_by_retrieval(docs, 6)) == list(range(5))


def test_every_term_of_a_seed_is_scored():
    draw = np.random.default_rng(8)
    seed = np.arange(100, dtype=np.uint32)
    # Ids 0 to 29 are the rarest; only commoner ones are shared with the later documents.
    docs = [seed, seed[:30], *[np.append(seed[50 + i:], np.uint32(1000 + i)) for i in range(40)],
            *[draw.integers(200, 400, 60).astype(np.uint32) for _ in range(400)]]
    index = packing.Bm25(docs)
    n, size = len(docs), np.array([len(d) for d in docs])
    norm = packing.K1 * (1 - packing.B + packing.B * size / size.mean())
    expected = np.zeros(n)
    for t in seed:
        tf = np.array([(d == t).sum() for d in docs])
        df = (tf > 0).sum()
        if df > 1:
            expected += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + norm)
    unused = np.ones(n, bool)
    unused[:2] = False
    assert set(index.neighbours(0, unused)) == set(range(2, 42))
    assert np.allclose(index.scores, expected, rtol=1e-4)


def test_scores_are_added_in_the_order_of_terms(monkeypatch):
    draw = np.random.default_rng(5)
    docs = [draw.zipf(1.3, draw.integers(1, 300)).clip(0, 5000).astype(np.uint32) for _ in range(200)]
    for block in (1, 1000, packing.BLOCK):
        monkeypatch.setattr(packing, "BLOCK", block)
        index = packing.Bm25(docs)
        for seed in range(0, 200, 7):
            expected = np.zeros(200, np.float32)
            at = index.queries[seed]
            for k in [*at[index.row[at] >= 0], *at[index.row[at] < 0]]:
                part = slice(index.starts[k], index.ends[k])
                expected[index.owner[part]] += index.weight[part]
            index.score(seed)
            assert (index.scores == expected).all()


def test_end_ids_are_not_shared_terms():
    docs = [np.array(x, np.uint32) for x in ([2, 3, 1], [9, 8, 7, 6, 1], [5, 1])]
    assert packing.order_by_retrieval(docs, 100, ends=1) == [0, 1, 2]


def test_shards_depend_on_the_documents_alone(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(i, f"topic {i % 7} words {i} of {i * 31 % 97} " * (1 + i % 30)) for i in range(400)]
    rows += [(1000 + i, "a copy of one text in many rows") for i in range(300)] + [(2000 + i, None) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for partitions in ("3", "20"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            pieces = packing.pack(table.repartition(int(partitions)), path, end_id=1, length=128, shard_tokens=3000).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        found.append(sorted(pieces))
    assert found[0] == found[1]
    sequences = defaultdict(int)
    for p in found[0]:
        sequences[p.sequence_id] += p.length
    ids = sum(sequences.values())
    assert len({s >> 26 for s in sequences}) > 5
    assert len(sequences) * 128 < 1.1 * ids
    assert sum(1 for n in sequences.values() if n < 128) <= len({s >> 26 for s in sequences})
    one = packing.pack(table, path, end_id=1, length=128).collect()
    assert len({p.sequence_id for p in one}) == -(-ids // 128)


def test_many_documents_without_a_neighbour_take_no_time():
    import time

    empty = [np.array([1], np.uint32)] * 200_000
    lone = [np.array([10 + i, 1], np.uint32) for i in range(50_000)]
    started = time.time()
    order = packing.order_by_retrieval(empty + lone, 2048, ends=1)
    assert sorted(order) == list(range(250_000)) and time.time() - started < 30

