"""Tables in parts, the filter by a bitmap of keys, and the load's one pass over the feed."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.dataframe import DataFrame as kind

import items as I
from goldweave import schema as S
from goldweave import session
from goldweave.operators import insert_new, upsert
from goldweave.operators.filters import key_filter
from goldweave.operators.latest import catch_up
from goldweave.plans import item_load
from goldweave.plans.audit import Audit, read_audit
from goldweave.sources import Layout, Store, publish, publish_touched
from test_item_load import HOUR, World, random_world, small_session  # noqa: F401

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
LAYOUT = Layout(("k",), 16)


def rows(spark, pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def state(store):
    return sorted(((r.k, r.v) for r in store.read("t", SCHEMA).collect()), key=repr)


@pytest.fixture
def store(spark):
    return Store(spark, session.scratch(spark, "parts"))


def test_only_touched_parts_are_written(spark, store):
    every = {f"k{i}": i for i in range(200)} | {None: -1}
    store.commit([store.write_parts(rows(spark, every.items()), "t", "r1", LAYOUT)], "r1")
    before = store._current("t")["part_paths"]
    assert len(before) == 16 and store.layout("t") == LAYOUT
    change = rows(spark, [("k3", 300), ("k4", 400), ("new", 1)])
    done = publish_touched(
        store, "t", SCHEMA, "r2", LAYOUT, change,
        lambda old: upsert(old, change, ["k"], ["v"], ["k", "v"]))
    after = store._current("t")["part_paths"]
    assert 1 <= len(done.rewritten) <= 3 and done.rewritten == LAYOUT.of(change)
    assert {n for n in after if after[n] != before.get(n)} == done.rewritten
    assert state(store) == sorted((every | {"k3": 300, "k4": 400, "new": 1}).items(), key=repr)


def test_parts_that_lose_all_rows_and_tables_that_are_empty(spark, store):
    store.commit([store.write_parts(rows(spark, []), "t", "r0", LAYOUT)], "r0")
    assert state(store) == []
    one = rows(spark, [("a", 1), ("b", 2)])
    publish_touched(store, "t", SCHEMA, "r1", LAYOUT, one, lambda old: old.union(one))
    gone = one.where("k = 'a'")
    publish_touched(store, "t", SCHEMA, "r2", LAYOUT, gone, lambda old: old.where("k != 'a'"))
    assert state(store) == [("b", 2)]
    publish_touched(store, "t", SCHEMA, "r3", LAYOUT, one.limit(0), lambda old: old)
    assert state(store) == [("b", 2)]


def test_a_row_of_another_part_is_refused(spark, store):
    publish_touched(store, "t", SCHEMA, "r1", LAYOUT, rows(spark, []), lambda old: rows(spark, [("a", 1), ("b", 2)]))
    with pytest.raises(ValueError, match="touched"):
        publish_touched(
            store, "t", SCHEMA, "r2", LAYOUT, rows(spark, [("a", 1)]),
            lambda old: old.union(rows(spark, [(f"x{i}", i) for i in range(40)])))
    assert state(store) == [("a", 1), ("b", 2)]


def test_another_layout_is_written_as_a_whole(spark, store):
    publish(rows(spark, [("a", 1), ("b", 2)]), store, "t", "plain")
    one = rows(spark, [("a", 5)])
    for run, layout in (("r1", LAYOUT), ("r2", Layout(("k",), 3))):
        done = publish_touched(
            store, "t", SCHEMA, run, layout, one, lambda old: upsert(old, one, ["k"], ["v"], ["k", "v"]))
        assert state(store) == [("a", 5), ("b", 2)] and store.layout("t") == layout
        assert done.rewritten == layout.of(store.read("t", SCHEMA))
    publish(rows(spark, [("c", 3)]), store, "t", "plain again")
    assert state(store) == [("c", 3)] and store.layout("t") is None


def test_a_master_in_parts_is_that_of_the_model(spark, monkeypatch):
    for seed, small in ((3, True), (4, False)):
        if not small:
            monkeypatch.setattr("goldweave.plans.item_load.fits_in_memory", lambda *s: False)
        w = random_world(spark, seed)
        first = w.run(mode="B", parts=8, run_id="p1")
        want = I.load(w.master, w.feed, [], [], mode="B")
        assert I.comparable(w.result()) == I.comparable(want)
        before = w.store._current("mst_item")["part_paths"]
        again = w.run(mode="B", parts=8, run_id="p2", run_ts=I.RUN_TS + HOUR)
        after = w.store._current("mst_item")["part_paths"]
        changed = {n for n in after if after[n] != before.get(n)}
        assert again.counts["parts_written"] == len(changed) <= first.counts["parts_written"] <= 8
        items = {r["item_id"] for r in w.feed if r["sys_source"] == "S1" or r["sys_ent_state"] == "DELETED"}
        assert changed <= Layout(("item_id",), 8).of(spark.createDataFrame([(i,) for i in items], "item_id string"))


def test_a_filter_keeps_every_wanted_key(spark):
    every = spark.range(20_000).select((F.col("id") % 5000).alias("a"), F.col("id").cast("string").alias("b"))
    wanted = spark.range(300).select((F.col("id") * 7).alias("a"), (F.col("id") * 7).cast("string").alias("b"))
    held = key_filter(every, wanted, ["a", "b"])
    assert held.columns == every.columns
    assert held.join(wanted, ["a", "b"], "left_semi").count() == every.join(wanted, ["a", "b"], "left_semi").count() == 300
    assert held.count() < 310
    # Hardly any words: all keys in few places, and still none is lost.
    tight = key_filter(every, wanted, ["a", "b"], words=1)
    assert tight.join(wanted, ["a", "b"], "left_semi").count() == 300
    assert key_filter(every, wanted.limit(0), ["a", "b"]).count() == 0


def test_messages_that_cannot_win_are_not_shuffled(spark, tmp_path_factory):
    path = session.scratch(spark, "log")
    spark.range(40_000).selectExpr(
        "cast(id % 4000 as string) AS item", "id AS seq_num", "sha2(string(id), 256) AS text"
    ).repartition(4).write.parquet(path)
    log = spark.read.parquet(path)
    maxima = log.where("seq_num >= 39900").selectExpr("item", "seq_num", "0L AS window")
    won = catch_up(log, maxima)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = won._jdf.queryExecution().executedPlan().toString()
        join = text.index("SortMergeJoin")
        wide = text[join:]
        # The wide side is cut by the broadcast bitmap below its shuffle.
        assert wide.index("Exchange hash") < wide.index("BroadcastHashJoin") < wide.index("seq_num:bigint,text:string>")
        assert won.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@contextmanager
def recorded_plans():
    """The plans of all actions."""
    plans = []
    before = {n: kind.__dict__[n] for n in ("write", "collect", "count", "first", "isEmpty") if n in kind.__dict__}

    def note(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def wrapped(fn):
        def call(self, *a, **k):
            note(self)
            return fn(self, *a, **k)
        return call

    for n, fn in before.items():
        if isinstance(fn, property):
            setattr(kind, n, property(wrapped(fn.fget)))
        else:
            setattr(kind, n, wrapped(fn))
    try:
        yield plans
    finally:
        for n, fn in before.items():
            setattr(kind, n, fn)


@pytest.mark.parametrize("mode", ["A", "C"])
def test_the_feed_is_scanned_once(spark, mode):
    spark.conf.set("spark.sql.maxMetadataStringLength", "500")
    try:
        w = random_world(spark, 5)
        with recorded_plans() as plans:
            w.run(mode=mode)
        scans = sum(line.count(w.paths.feed) for p in plans for line in p.splitlines() if "Scan parquet" in line)
        assert scans == 1
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_numbers_of_a_staged_feed(spark):
    feed = [
        I.feed_row(item_id="A", transaction_seq=3), I.feed_row(item_id="B", transaction_seq=9, sys_ent_state="DELETED"),
        I.feed_row(item_id="C", transaction_seq=99, sys_source="S2", sys_ent_state="DELETED"),
        I.feed_row(item_id="D", transaction_seq=99, sys_source="S2"), I.feed_row(item_id="E", sys_source=None),
    ]
    rows = I.frame(spark, feed, S.FEED_SCHEMA)
    found = item_load.stage_feed(rows, "S1")
    assert (found.in_rows, found.highest, found.deleted, found.size.rows) == (2, 9, 2, 4)
    assert sorted(r.item_id for r in found.rows.collect()) == ["A", "B", "C"]
    assert sorted(r.item_id for r in found.mine().collect()) == ["A", "B"]
    kept = item_load.stage_feed(rows, "S1", delete=False)
    assert (kept.in_rows, kept.deleted, kept.rows.count()) == (2, 0, 2)
    none = item_load.stage_feed(rows, "S9")
    assert (none.in_rows, none.highest) == (0, None)


@pytest.mark.parametrize("fits", [True, False])
def test_insert_new_from_written_tables(spark, monkeypatch, fits):
    monkeypatch.setattr("goldweave.operators.load.fits_in_memory", lambda *s: fits)
    rnd = random.Random(fits)
    target = spark.createDataFrame([(str(i), "1", "t") for i in range(0, 40, 2)], "k string, r string, a string")
    rows = spark.createDataFrame(
        [(rnd.choice([None, *map(str, range(60))]), "1", rnd.choice("xyz")) for _ in range(400)], target.schema)
    names = []

    def stage(df, name):
        names.append(name)
        return session.staged(df, name)

    plain = insert_new(target, rows, ["k", "r"], ["k", "r", "a"])
    written = insert_new(target, rows, ["k", "r"], ["k", "r", "a"], stage=stage)
    assert names == ["new-keys", "new-rows"]
    for part in ("inserted", "duplicates", "target"):
        assert sorted(getattr(written, part).collect(), key=repr) == sorted(getattr(plain, part).collect(), key=repr)


def test_an_audit_that_fails_after_the_commit_is_a_warning(spark, monkeypatch):
    w = World(spark, feed=[I.feed_row(item_id="A")])

    def broken(self, *a, **k):
        raise OSError("audit is full")

    monkeypatch.setattr(Audit, "end", broken)
    done = w.run(run_id="r1")
    assert done.code == 0 and done.version and "audit is full" in done.warnings[0]
    assert [r["item_id"] for r in w.result()] == ["A"]
    assert not [r for r in read_audit(spark, w.paths.audit).collect() if r.status.startswith("ERROR")]


def test_how_a_load_ended(spark, monkeypatch):
    w = World(spark, feed=[I.feed_row(item_id="A", eol_date="bad"), I.feed_row(item_id="B")], jobs=[])
    options = {"run_ts": I.RUN_TS, "run_user": I.USER}

    def ended(**more):
        return tuple(item_load.load_outcome(spark, w.paths, "S1", "items", **options, **more).first())[:5]

    assert ended() == (1, "frequency of items: expected one row, found none", "lookups", False, 0)
    w = World(spark, feed=[I.feed_row(item_id="A", eol_date="bad"), I.feed_row(item_id="B")])
    code, message, location, published, _ = ended(run_id="a")
    assert (code, location, published) == (1, "merge", False) and "eol_date" in message
    assert ended(run_id="b", bad_dates="reject") == (0, "SUCCESS", "done", True, 0)
    assert ended(run_id="b")[2] == "call" and ended(mode="X")[2] == "call"


def test_a_part_is_written_by_few_tasks(spark, store):
    many = rows(spark, [(f"k{i}", i) for i in range(2000)]).repartition(16)
    written = store.write_parts(many, "t", "r1", LAYOUT)
    files = spark.read.schema(SCHEMA).parquet(written.path).select(F.input_file_name()).distinct().count()
    assert files <= 32
