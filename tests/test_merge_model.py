"""The set-based merge against rows applied one at a time to a dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from goldweave.operators import MergeSource, collapse, insert_new, merge, update_by_key, upsert

KEYS = ["k", "r"]
COLUMNS = ["k", "r", "a", "b", "c", "d"]
SCHEMA = "k string, r string, a string, b string, c string, d string"


def order_key(row, columns):
    return tuple((row[c] is not None, row[c] or "") for c in columns)


def random_rows(rng, n, null_keys=False):
    rows = []
    for _ in range(n):
        row = {c: rng.choice([None, "x", "y", "z"]) for c in COLUMNS}
        row["k"] = rng.choice(["A", "B", "C", "D"] + ([None] if null_keys else []))
        row["r"] = rng.choice([" ", "1"])
        rows.append(row)
    return rows


def apply(target, source, update, insert):
    """One row after the other."""
    target = [dict(t) for t in target]
    for s in source:
        hits = [
            t for t in target
            if None not in (s["k"], s["r"]) and t["k"] == s["k"] and t["r"] == s["r"]
        ]
        for t in hits:
            t.update({c: s[c] for c in update})
        if not hits and insert:
            target.append({c: s[c] if c in insert else None for c in COLUMNS})
    return target


def as_set(rows):
    return sorted(tuple(str(r[c]) for c in COLUMNS) for r in rows)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("small", [False, True])
def test_two_merges_and_an_update(spark, seed, small):
    rng = random.Random(seed)
    target = list({(t["k"], t["r"]): t for t in random_rows(rng, 4)}.values())
    one = random_rows(rng, 8, null_keys=True)
    two = random_rows(rng, 8, null_keys=True)
    three = random_rows(rng, 5)
    update1, insert1 = ["b"], ["k", "r", "a", "b", "c"]
    update2, insert2 = ["a", "d"], ["k", "r", "a", "b", "d"]

    def ordered(rows, insert, update):
        payload = list(dict.fromkeys([c for c in [*insert, *update] if c not in KEYS]))
        return sorted(rows, key=lambda r: order_key(r, payload))

    expected = apply(target, ordered(one, insert1, update1), update1, insert1)
    expected = apply(expected, ordered(two, insert2, update2), update2, insert2)
    expected = apply(expected, ordered(three, [], ["c"]), ["c"], [])
    got = merge(
        frame(spark, target),
        [
            MergeSource("one", frame(spark, one), update1, insert1),
            MergeSource("two", frame(spark, two), update2, insert2),
            MergeSource("three", frame(spark, three), ["c"]),
        ],
        KEYS,
        small_sources=small,
    )
    assert as_set(r.asDict() for r in got.collect()) == as_set(expected)


def test_match_overwrites_with_null(spark):
    target = frame(spark, [dict(k="A", r=" ", a="x", b="x", c="x", d="x")])
    rows = frame(spark, [dict(k="A", r=" ", a=None, b="y", c=None, d=None)])
    got = upsert(target, rows, KEYS, ["a", "b"], ["k", "r", "a", "b"]).first()
    assert (got.a, got.b, got.c) == (None, "y", "x")


def test_first_and_last_row(spark):
    rows = spark.createDataFrame(
        [("A", "1", 1, "x", "d1"), ("A", "1", 2, "y", "d2")],
        "k string, r string, seq int, name string, description string",
    )
    got = collapse(rows, KEYS, insert_only=["description"], updated=["name"], order=["seq"])
    assert [tuple(x) for x in got.collect()] == [("A", "1", "d1", "y")]


def test_duplicate_target_keys_are_all_updated(spark):
    target = frame(spark, [dict(k="A", r="1", a=v, b="x", c=None, d=None) for v in "xyz"])
    rows = frame(spark, [dict(k="A", r="1", a=None, b="new", c=None, d=None)])
    got = upsert(target, rows, KEYS, ["b"], ["k", "r", "b"]).collect()
    assert sorted((r.a, r.b) for r in got) == [(v, "new") for v in "xyz"]


def test_updated_column_must_be_inserted(spark):
    target = frame(spark, [])
    with pytest.raises(ValueError, match="never inserted"):
        upsert(target, target, KEYS, ["a"], KEYS)
    with pytest.raises(ValueError, match="keys cannot"):
        upsert(target, target, KEYS, ["k"], KEYS)


@pytest.mark.parametrize("seed", range(4))
def test_insert_new(spark, seed):
    rng = random.Random(seed)
    target = list({(t["k"], t["r"]): t for t in random_rows(rng, 3)}.values())
    rows = random_rows(rng, 14, null_keys=True)
    distinct = {tuple(r.items()): r for r in rows}.values()
    known = {(t["k"], t["r"]) for t in target}
    seen, inserted, duplicates = set(), [], []
    for r in sorted(distinct, key=lambda r: order_key(r, ["a", "b", "c", "d"])):
        key = (r["k"], r["r"])
        if key in known:
            continue
        if key in seen and r["k"] is not None:
            duplicates.append(r)
        else:
            seen.add(key)
            inserted.append(r)
    got = insert_new(frame(spark, target), frame(spark, rows), KEYS, COLUMNS)
    assert as_set(r.asDict() for r in got.inserted.collect()) == as_set(inserted)
    assert as_set(r.asDict() for r in got.duplicates.collect()) == as_set(duplicates)
    assert got.target.count() == len(target) + len(inserted)


def test_update_by_part_of_the_key(spark):
    target = frame(spark, [dict(k="A", r=r, a="x", b="x", c=None, d=None) for r in "123"])
    flags = frame(spark, [dict(k="A", r=None, a=v, b=None, c=None, d=None) for v in "pq"])
    got = update_by_key(
        target, flags, ["k"], ["a", "b"], constants={"c": F.lit("stamp")}
    ).collect()
    assert sorted((r.r, r.a, r.b, r.c) for r in got) == [(r, "q", None, "stamp") for r in "123"]
