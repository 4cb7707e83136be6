"""The divergence audit against counts and sums taken one by one."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from goldweave.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, top):
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, words = lang or "", TERM.findall((text or "").translate(LOWER))
        counts[lang, source or ""].update(words)
        held[lang].update(set(words))
    out = []
    for lang in {g[0] for g in counts}:
        kept = sorted(w for w, n in held[lang].items() if n >= least)
        whole = sum((c for g, c in counts.items() if g[0] == lang), Counter())

        def prices(c):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (total + 5 * len(kept)) for w in kept}

        mine = {g[1]: prices(c) for g, c in counts.items() if g[0] == lang}
        usual = prices(whole)
        for s, p in mine.items():
            pairs = [(o, sum(abs(p[w] - q[w]) for w in kept)) for o, q in mine.items() if o != s]
            terms = [(w, p[w] - usual[w]) for w in kept if counts[lang, s][w] and p[w] > usual[w]]
            for part, values, limit in (("pair", pairs, None), ("term", terms, top)):
                values.sort(key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, s, part, w, v, k + 1) for k, (w, v) in enumerate(values[:limit])]
    return sorted(out)


def documents(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")


@pytest.mark.parametrize("blocks", [(64, 4096), (3, 5)])
def test_audit(spark, blocks):
    rng = np.random.default_rng(blocks[0])
    words = ["The", "the", "ÉA", "éa", "A", "z", "Ω", "𝒳y", "one-two", "x1y", "it's", "日本"] + [f"w{c}" for c in "abcdefghij"]
    rows = [
        (" ".join(words[int(i)] for i in rng.zipf(1.5, rng.integers(0, 30)).clip(1, len(words)) - 1),
         ["en", "fr", None][rng.integers(0, 3)], [None, "", *"bcdefghijk"][int(rng.integers(0, 12))])
        for _ in range(250)]
    rows += [("again again", "en", "b")] * 30 + [(None, "en", "none"), ("", "solo", "s")]
    rows += [("rare", "de", "p"), ("seldom", "de", "q"), (" 1 2 3", "de", "r")]
    found = divergence.audit(
        documents(spark, rows), min_documents=4, top=3, group_block=blocks[0], term_block=blocks[1])
    assert sorted(tuple(r) for r in found.collect()) == by_hand(rows, 4, 3)


def test_empty(spark):
    assert divergence.audit(documents(spark, [("a", "en", "s")]).limit(0)).collect() == []


def test_counts_beyond_a_long(spark):
    from pyspark.sql import functions as F

    n, total, terms = 5 * 10**11, 10**13 + 7, 10**7
    got = spark.range(1).select(divergence.price(
        F.lit(n), F.lit(total).cast("long"), F.lit(terms).cast("long")).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for shape, left, same in (((300, 7), 7, True), ((500, 9), 4, False), ((0, 3), 3, True), ((1, 1), 1, True)):
        prices = rng.integers(0, 60, shape) ** 3
        found = divergence.divergences(prices, left, same)
        other = prices if same else prices[:, left:]
        want = np.abs(prices[:, :left, None] - other[:, None, :]).sum(axis=0)
        i, j = np.triu_indices(left, 1) if same else map(np.ravel, np.indices(want.shape))
        assert (found[i, j] == want[i, j]).all()


def test_tables_hold_every_pair_of_levels():
    codes = np.array([[0, 1], [0, 0], [1, 1], [0, 1]])
    hot = divergence.one_hot(codes, np.array([2, 2]))
    assert (hot.T @ hot).tolist() == [[3, 0, 1, 2], [0, 1, 0, 1], [1, 0, 1, 0], [2, 1, 0, 3]]


def test_top_terms_are_limited_before_the_shuffle(spark):
    found = divergence.audit(documents(spark, [("a b", "en", "s")] * 3), min_documents=1)
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
