import os
import random
import tempfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import items as I
from goldweave import schema as S
from goldweave.operators import Windows, merge, window_maxima
from goldweave.plans.item_load import LoadInputs, _message_source, caught_up, instant
from goldweave.sources.snapshot import Store, publish
from goldweave.streaming.catchup import numbered, read_message_stream, start_catch_up, stream_maxima

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)


def us(t):
    return int(t.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000


def world(spark, seed, n=90):
    """Messages in three files, in the order of their times, and the windows due at the newest."""
    rng = random.Random(seed)
    rows = sorted(
        (
            I.message(
                item=rng.choice(["A", "B", "C", None]), seq_num=rng.randrange(6),
                item_description=rng.choice([None, "d1", "d2", "d3"]), part_type=rng.choice("pq"),
                sys_creation_date=START + rng.choice([1, 1, 1, 3]) * rng.randrange(0, 24) * HOUR,
            )
            for _ in range(n)
        ),
        key=lambda r: r["sys_creation_date"],
    )
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for k in range(3):
        part = I.frame(spark, rows[k * n // 3:(k + 1) * n // 3], S.MESSAGE_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/log")
        # the source takes older files first
        for f in os.listdir(f"{folder}/log"):
            path = f"{folder}/log/{f}"
            if f.endswith(".parquet") and os.path.getmtime(path) > 1_000_000_000:
                os.utime(path, (900_000_000 + k * 100, 900_000_000 + k * 100))
    newest = rows[-1]["sys_creation_date"]
    return folder, newest


def windows_until(newest, first_end=START + 6 * HOUR, start=START):
    n, end = 0, first_end
    while end + 12 * HOUR <= newest:
        n, end = n + 1, end + 6 * HOUR
    return Windows(us(start), us(first_end), 21_600, n)


@pytest.mark.parametrize("hours,start", [(6, 0), (13, 0), (6, 2)])
def test_maxima_equal_the_batch_ones(spark, hours, start):
    folder, newest = world(spark, hours + start)
    w = windows_until(newest, START + hours * HOUR, START + start * HOUR)
    stream = spark.readStream.schema(S.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    out = numbered(stream_maxima(stream, w), w)
    q = (
        out.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = spark.read.schema("item string, seq_num long, window long").parquet(f"{folder}/out")
    log = spark.read.schema(S.MESSAGE_SCHEMA).parquet(f"{folder}/log")
    expected = window_maxima(log, w)
    key = ["window", "item", "seq_num"]
    assert sorted(map(str, got.select(*key).collect())) == sorted(map(str, expected.select(*key).collect()))


def test_stream_into_the_master_equals_the_batch(spark):
    folder, newest = world(spark, 5)
    w = windows_until(newest)
    store = Store(spark, f"{folder}/store")
    master = I.frame(spark, [I.master_row(item_id="A", name="old", description="old")], S.MASTER_SCHEMA)
    publish(master, store, "mst_item", "seed")
    log = lambda: spark.read.schema(S.MESSAGE_SCHEMA).parquet(f"{folder}/log")
    run_ts = instant(I.RUN_TS)

    def run():
        stream = read_message_stream(spark, f"{folder}/log")
        q = start_catch_up(
            stream, w, store, log, name="bom", checkpoint=f"{folder}/cp", run_ts=run_ts, run_user=I.USER
        )
        q.awaitTermination()

    run()
    inputs = LoadInputs(master=master, feed=master, source="S1", run_ts=run_ts, run_user=I.USER)
    expected = merge(master, [_message_source(caught_up(log(), w), inputs)], S.KEYS)

    def current():
        return store.read("mst_item", S.MASTER_SCHEMA)

    assert I.comparable(current().collect()) == I.comparable(expected.collect())
    # nothing new: no further version
    versions = store.commits().count()
    run()
    assert store.commits().count() == versions
    assert store.last_window("bom") is not None


def test_a_new_checkpoint_merges_what_is_new_and_nothing_else(spark):
    folder, newest = world(spark, 6)
    store = Store(spark, f"{folder}/store")
    publish(I.frame(spark, [], S.MASTER_SCHEMA), store, "mst_item", "seed")
    w = windows_until(newest)
    log = lambda: spark.read.schema(S.MESSAGE_SCHEMA).parquet(f"{folder}/log")
    options = dict(name="bom", run_ts=instant(I.RUN_TS), run_user=I.USER)
    for checkpoint in ("one", "two"):
        # a checkpoint lost after the publish: the same batch numbers come again
        stream = read_message_stream(spark, f"{folder}/log")
        start_catch_up(stream, w, store, log, checkpoint=f"{folder}/{checkpoint}", **options).awaitTermination()
        seen = store.commits().where(F.col("stream") == "bom").count()
        assert seen == 1
    # a lost checkpoint and windows that finished since: nothing is lost
    late = I.frame(spark, [
        I.message(item=i, seq_num=99, item_description="late", sys_creation_date=newest + k * HOUR)
        for k, i in ((24, "Z"), (72, "Y"))], S.MESSAGE_SCHEMA)
    late.coalesce(1).write.mode("append").parquet(f"{folder}/log")
    stream = read_message_stream(spark, f"{folder}/log")
    start_catch_up(stream, w, store, log, checkpoint=f"{folder}/three", **options).awaitTermination()
    items = {r["item_id"] for r in store.read("mst_item", S.MASTER_SCHEMA).collect()}
    assert "Z" in items and "A" in items


def test_fraction_is_refused(spark):
    with pytest.raises(ValueError, match="whole second"):
        start_catch_up(None, Windows(0, 5, 60, 1), None, None, name="x", checkpoint="x", run_ts=None, run_user="u")
