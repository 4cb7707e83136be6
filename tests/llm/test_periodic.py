"""Runs of repeating words against a search of every period."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldweave.llm import periodic
from goldweave.llm.queries import planted


def every_run(words, least, periods):
    n, found = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


@st.composite
def text(draw):
    kinds = draw(st.sampled_from([1, 2, 3, 15]))
    words = draw(st.lists(st.integers(0, kinds - 1), max_size=90))
    if words and draw(st.booleans()):
        a = draw(st.integers(0, len(words) - 1))
        p = draw(st.integers(1, max(1, (len(words) - a) // 3)))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    return words


@settings(max_examples=150, deadline=None)
@given(st.lists(text(), min_size=1, max_size=5), st.sampled_from([(24, 3), (5, 2), (1, 2), (9, 4)]))
def test_runs_are_those_of_every_period(words, limits):
    found = periodic.runs_of([np.array(w, np.int64) for w in words], *limits)
    assert [tuple(r) for r in found.tolist()] == [
        (k, *r) for k, w in enumerate(words) for r in every_run(w, *limits)]


def test_extensions_both_ways():
    rng = np.random.default_rng(3)
    body = np.tile(rng.integers(0, 3, 7), 40)
    body[150] = 5
    sequence = np.concatenate([[9], body, [10]])
    grammar = periodic.Grammar(sequence)
    x = rng.integers(1, 281, 500)
    y = rng.integers(1, 281, 500)
    x, y = x[x != y], y[x != y]
    for step in (1, -1):
        for a, b, n in zip(x, y, grammar.extend(x, y, step), strict=True):
            m = 0
            while sequence[a + step * m] == sequence[b + step * m]:
                m += 1
            assert n == m


def test_more_candidates_than_a_block(monkeypatch):
    words = [np.arange(400) % 7, np.arange(90), np.zeros(120, np.int64)]
    whole = periodic.runs_of(words, 24, 3)
    monkeypatch.setattr(periodic, "BLOCK", 17)
    assert periodic.runs_of(words, 24, 3).tolist() == whole.tolist() == [[0, 0, 400, 7], [2, 0, 120, 1]]


def test_two_periods_at_least():
    with pytest.raises(ValueError):
        periodic.runs_of([np.zeros(30, np.int64)], 24, 1)


def test_table(spark):
    again = "a b c " * 10
    rows = [
        (1, f"start {again}end", "x"), (1, f"start {again}end", "x"), (None, None, "x"), (2, "", "x"),
        (3, " w x \t\n" * 30, "x"), (4, "x " * 100_000, "x"), (5, "none", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = periodic.find_runs(docs).collect()
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found)
    assert got == [
        (0, 0, [], ""),
        (1, 32, [(1, 30, 3)], "start a b c end"), (1, 32, [(1, 30, 3)], "start a b c end"),
        (2, 0, [], ""), (3, 30, [(0, 30, 1)], " w x"), (4, 100_000, [(0, 100_000, 1)], "x"),
        (5, 1, [], "none"),
    ]
    assert periodic.find_runs(docs.limit(0)).collect() == []


def test_planted_periods(spark):
    import zlib

    rows = [(k, " ".join(f"w{i}" for i in range(k % 57))) for k in range(300)] + [(None, "a b")]
    found = {r.id: r.text for r in planted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[None] == "a b"
    for k, t in rows[:-1]:
        words, h = t.split(), zlib.crc32(str(k).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert found[k].split() == words
