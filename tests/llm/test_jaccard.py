"""The near-duplicate join against all pairs."""

import random

from goldweave.llm import jaccard

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed=3, n=60):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        base = [draw.choice(WORDS) for _ in range(draw.choice([6, 40, 120, 300]))]
        out.append(" ".join(base))
        for _ in range(draw.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 2, 5])):
                copy[draw.randrange(len(copy))] = draw.choice(WORDS)
            out.append(" ".join(copy))
    return list(enumerate([*out, "", None, "a b", "A  b!", "one", "x" * 50_000]))


def expected(rows, k=5, threshold=0.8):
    sets = {}
    for i, text in rows:
        w = jaccard.words_of(text or "")
        sets[i] = (tuple(w), {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    links = {i: set() for i, _ in rows}
    for i, (wi, a) in sets.items():
        for j, (wj, b) in sets.items():
            if i != j and a and b and (wi == wj or len(a & b) >= threshold * len(a | b)):
                links[i].add(j)
    root = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root[i] = min(seen)
    return {i: (root[i], len(links[i])) for i in links}


def test_links_and_classes_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SET_BLOCK", 3)
    monkeypatch.setattr(jaccard, "NODE_BLOCK", 3)
    rows = corpus()
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in found} == expected(rows)


def test_repeated_rows_null_ids_and_other_columns(spark):
    text = "one two three four five six seven"
    rows = [(1, text, 0), (1, text, 0), (None, text, 1), (2, "something else entirely here now ok", 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, node int")
    found = jaccard.near_duplicates(table).collect()
    assert sorted((r.class_id, r.n_links) for r in found) == [(1, 2), (1, 2), (1, 2), (2, 0)]
    assert jaccard.near_duplicates(table.limit(0)).count() == 0


def test_lone_pairs_at_the_threshold_are_found_beside_a_large_group(spark):
    draw = random.Random(5)
    rows = []
    for i in range(1500):  # 40 of 50 shingles are shared
        base = [f"p{i}x{draw.randrange(10**9)}" for _ in range(49)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:-5], *"abcde"]))]
    large = [f"g{k}" for k in range(200)]
    rows += [(3000 + i, " ".join([*large, f"end{i}"])) for i in range(300)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    links = {r.doc_id: r.n_links for r in found}
    assert sum(links[2 * i] for i in range(1500)) >= 0.999 * 1500
    assert all(links[3000 + i] == 299 for i in range(300))
