"""The stream that finds its winners in its own state."""

import os
import tempfile

import pytest

import items as I
from goldweave import schema as S
from goldweave.operators import Windows, merge
from goldweave.plans.item_load import LoadInputs, _message_source, caught_up, instant
from goldweave.sources import Layout, Store, publish
from goldweave.streaming import catchup
from test_parts import recorded_plans
from test_streaming import HOUR, START, windows_until, world


def run(spark, folder, w, store, checkpoint="cp", **options):
    stream = spark.readStream.schema(S.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    catchup.start_state_catch_up(
        stream, w, store, name="bom", checkpoint=f"{folder}/{checkpoint}", run_ts=instant(I.RUN_TS),
        run_user=I.USER, **options).awaitTermination()
    return I.comparable(store.read("mst_item", S.MASTER_SCHEMA).collect())


def append(spark, folder, rows, mtime):
    os.makedirs(f"{folder}/log", exist_ok=True)
    before = set(os.listdir(f"{folder}/log"))
    I.frame(spark, rows, S.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    for f in set(os.listdir(f"{folder}/log")) - before:
        if f.endswith(".parquet"):
            os.utime(f"{folder}/log/{f}", (mtime, mtime))


@pytest.mark.parametrize("layout", [None, Layout(("item_id",), 4)])
def test_the_master_is_that_of_the_batch(spark, layout):
    folder, newest = world(spark, 5)
    w = windows_until(newest)
    store = Store(spark, f"{folder}/store")
    master = I.frame(spark, [I.master_row(item_id="A", name="old", description="old")], S.MASTER_SCHEMA)
    publish(master, store, "mst_item", "seed")
    spark.conf.set("spark.sql.maxMetadataStringLength", "500")
    try:
        with recorded_plans() as plans:
            got = run(spark, folder, w, store, layout=layout)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # Messages reach a batch as rows of the stream only.
    assert len(plans) > 5
    assert not [x for p in plans for x in p.splitlines() if f"{folder}/log" in x and "Scan parquet" in x]
    log = spark.read.schema(S.MESSAGE_SCHEMA).parquet(f"{folder}/log")
    inputs = LoadInputs(master=master, feed=master, source="S1", run_ts=instant(I.RUN_TS), run_user=I.USER)
    # Files come in order of their times here, but a tie may come in after its window was merged.
    want = I.comparable(merge(master, [_message_source(caught_up(log, w), inputs)], S.KEYS).collect())
    late = store.read_all(catchup.LATE_TABLE, catchup.LATE_SCHEMA).collect()
    if not late:
        assert got == want
    assert len(got) == len(want)
    versions = store.commits().count()
    assert run(spark, folder, w, store, layout=layout) == got
    assert store.commits().count() == versions


def rows_of(store):
    return {r.item_id: r.description for r in store.read("mst_item", S.MASTER_SCHEMA).collect()}


def test_late_messages_are_set_aside_and_a_new_checkpoint_adds_none(spark):


    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    store = Store(spark, f"{folder}/store")
    publish(I.frame(spark, [], S.MASTER_SCHEMA), store, "mst_item", "seed")
    w = windows_until(START + 48 * HOUR)

    def at(hours, item, seq, text):
        return I.message(item=item, seq_num=seq, item_description=text, sys_creation_date=START + hours * HOUR)

    append(spark, folder, [at(1, "A", 5, "first"), at(2, "B", 1, "b")], 900_000_000)
    append(spark, folder, [at(30, "A", 6, "next")], 900_000_100)
    run(spark, folder, w, store)
    assert rows_of(store) == {"A": "first", "B": "b"}
    # One of the number that won in the first window, which has been merged.
    append(spark, folder, [at(3, "A", 5, "too late"), at(200, "C", 1, "c")], 900_000_200)
    append(spark, folder, [at(300, "D", 1, "d")], 900_000_300)
    run(spark, folder, w, store)
    assert rows_of(store) == {"A": "next", "B": "b", "C": "c"}

    def late():
        return [(r.item, r.item_description, r.window_end) for r in store.read_all(
            catchup.LATE_TABLE, catchup.LATE_SCHEMA).collect()]

    assert late() == [("A", "too late", START + 6 * HOUR)]
    commits = store.commits().count()
    run(spark, folder, w, store, checkpoint="another")
    assert rows_of(store) == {"A": "next", "B": "b", "C": "c"}
    assert len(late()) == 1 and store.commits().count() == commits


def test_fraction_is_refused(spark):
    with pytest.raises(ValueError, match="whole second"):
        catchup.start_state_catch_up(None, Windows(0, 5, 60, 1), None, name="x", checkpoint="x", run_ts=None, run_user="u")
