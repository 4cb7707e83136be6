"""A large load is done in goes: the outcome is the same, and what a go shuffled leaves the disk."""

import glob
import time

import pytest

import items as I
from goldweave import schema as S
from goldweave import session
from goldweave.operators.quarantine import Rule
from goldweave.plans import item_load
from goldweave.sources import Store
from test_item_load import HOUR, due, random_world, small_session  # noqa: F401


@pytest.fixture
def goes(monkeypatch):
    """Loads in as many goes as there may be; the list has the goes planned so far."""
    planned, plan = [], item_load.plan_load

    def counted(i):
        planned.append(i.mode)
        return plan(i)

    monkeypatch.setattr(item_load, "fits_in_memory", lambda *s: False)
    monkeypatch.setattr(item_load, "plan_load", counted)
    monkeypatch.setattr(item_load, "GO_BYTES", 1)
    return planned


def ended(w, result):
    plain = [[str(r[c]) for c in ("item_id", "revision", "step", "sys_err_code", "name")] for r in w.rejects()]
    return I.comparable(w.result()), result.counts, sorted(plain)


@pytest.mark.parametrize("mode,options,n", [("A", {"buckets": 4}, 4), ("B", {"parts": 8}, 4), ("C", {"parts": 3}, 3)])
def test_the_outcome_is_that_of_one_go(spark, monkeypatch, goes, mode, options, n):
    w = random_world(spark, 7)
    found = ended(w, w.run(mode=mode, **options))
    assert len(goes) == n
    assert found[0] == I.comparable(I.load(w.master, w.feed, w.messages, due(3), mode=mode))
    if mode == "B":  # into the parts that are there
        w.run(mode="B", run_id="again", run_ts=I.RUN_TS + HOUR, **options)
        assert len(goes) == 2 * n
        rows = I.load(w.master, w.feed, [], [], mode="B")
        rows = I.load(rows, w.feed, [], [], mode="B", run_ts=I.RUN_TS + HOUR)
        assert I.comparable(w.result()) == I.comparable(rows)
    if mode != "C":
        return
    monkeypatch.setattr(item_load, "GO_BYTES", 1 << 40)
    one = random_world(spark, 7)
    planned = len(goes)
    assert ended(one, one.run(mode=mode, **options)) == found
    assert len(goes) == planned + 1


def test_a_go_reads_its_own_folder_of_the_staged_feed(spark):
    feed = [I.feed_row(item_id=i, transaction_seq=k) for k, i in enumerate(["A", "B", "C", "D", "E", None])]
    goes = item_load.Goes(3)
    staged = item_load.stage_feed(I.frame(spark, feed, S.FEED_SCHEMA), "S1", goes=goes)
    assert (staged.in_rows, staged.highest) == (6, 5)
    found = [staged.of(k) for k in range(3)]
    assert sorted((r.item_id for f in found for r in f.collect()), key=str) == ["A", "B", "C", "D", "E", None]
    for k, rows in enumerate(found):
        assert rows.where(goes.number() != k).isEmpty()
        assert "PartitionFilters: [isnotnull(_go" in rows._jdf.queryExecution().executedPlan().toString()


def shuffled(spark):
    """The shuffle files on the disk."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in blocks.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_what_was_shuffled_for_the_master_is_deleted_once_it_is_written(spark, monkeypatch, goes):
    counts, left = item_load.merge_counts, []

    def after_the_master(*a):
        until = time.time() + 20
        while shuffled(spark) - before and time.time() < until:
            time.sleep(0.2)
        left.extend(shuffled(spark) - before)
        return counts(*a)

    monkeypatch.setattr(item_load, "merge_counts", after_the_master)
    w = random_world(spark, 8)
    before = shuffled(spark)
    w.run(mode="B", parts=8)
    assert len(goes) == 4 and left == []


def tables(spark):
    return set(glob.glob(f"{session.shared_folder(spark).removeprefix('file:')}/goldweave/*"))


def test_tables_staged_for_a_load_go_with_it(spark, goes):
    w = random_world(spark, 9)
    before = tables(spark)
    w.run()
    assert tables(spark) == before
    w.run(mode="C", run_id="c")
    with pytest.raises(item_load.LoadFailed):
        w.run(mode="B", run_id="b", feed_rules=[Rule(1, "wrong", "no_such_column = 1")])
    assert tables(spark) == before


def test_a_staged_table_that_cannot_be_deleted_is_a_warning(spark, monkeypatch):
    monkeypatch.setattr(session, "scratch", lambda spark, name: "nosuch://x/y")
    with pytest.warns(UserWarning, match="was not deleted"):
        with pytest.raises(Exception), session.passing_tables(spark):
            session.staged(spark.range(1), "t")


def test_a_bucketed_table_is_written_by_the_tasks_that_have_the_rows(spark):
    """It was shuffled once more, wide as it is, and sorted by bucket in as few tasks as buckets."""
    store = Store(spark, session.scratch(spark, "buckets"))
    rows = spark.range(0, 3000, numPartitions=3).selectExpr("cast(id as string) AS k", "id AS v")
    before = shuffled(spark)
    with session.load_settings(spark):
        written = store.write([rows, rows.selectExpr("concat('x', k) AS k", "v")], "t", "r", buckets=4, bucket_columns=["k"])
        assert shuffled(spark) <= before
        store.commit([written], "r")
        found = store.read("t", rows.schema)
        assert sorted(r.k for r in found.collect()) == sorted(f"{x}{i}" for x in ("", "x") for i in range(3000))
        sums = found.groupBy("k").count()
        assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
        assert sums.where("count > 1").isEmpty()
    assert len(glob.glob(f"{written.path.removeprefix('file:')}/*.parquet")) == 2 * 3 * 4
