"""What the plans must look like to hold at scale."""

import tempfile
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from goldweave import schema as S
from goldweave.operators import (
    MergeSource,
    catch_up,
    collapse,
    expand_to_keys,
    insert_new,
    latest_in_window,
    merge,
    update_by_key,
    upsert,
)
from goldweave.sources import read_feed

KEYS = ["k", "r"]


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan AQE ended with."""
    df.collect()
    return plan(df)


def depth_of(text, marker):
    """Exchanges on the way from the root to the line with a marker."""
    stack = []
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        while stack and stack[-1][0] >= indent:
            stack.pop()
        stack.append((indent, line))
        if marker in line:
            return sum("Exchange hash" in x for _, x in stack)
    raise AssertionError(f"{marker} not in plan")


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    n = 20_000
    target = spark.range(n).select(
        F.col("id").cast("string").alias("k"), F.lit("1").alias("r"), F.lit("t").alias("a"),
        F.lit("t").alias("b"),
    )
    # a third of the rows have one key
    rows = spark.range(3 * n).select(
        F.when(F.col("id") < n, "hot").otherwise((F.col("id") + n // 2).cast("string")).alias("k"),
        F.lit("1").alias("r"), F.sha2(F.col("id").cast("string"), 256).alias("a"),
        F.col("id").cast("string").alias("b"),
    )
    target.repartition(4).write.parquet(f"{root}/target")
    rows.repartition(8).write.parquet(f"{root}/rows")
    return spark.read.parquet(f"{root}/target"), spark.read.parquet(f"{root}/rows")


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1"}
SPLIT = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
}


def test_feed_scan_reaches_the_files(spark):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.createDataFrame([], S.FEED_SCHEMA).write.parquet(f"{root}/feed")
    text = plan(read_feed(spark, f"{root}/feed", "S1").select("item_id", "is_emc"))
    assert "EqualTo(sys_source,S1)" in text
    assert "ReadSchema: struct<item_id:string,is_emc:string,sys_source:string>" in text


def test_three_sources_shuffle_the_target_once(spark, tables):
    target, rows = tables
    sources = [
        MergeSource("one", rows, ["b"], ["k", "r", "a", "b"]),
        MergeSource("two", rows, ["a"], ["k", "r", "a"]),
        MergeSource("gone", rows.select("k", "r"), ["b"], constants={"b": F.lit("x")}),
    ]
    with settings(spark, **NO_BROADCAST):
        text = plan(merge(target, sources, KEYS, null_keys="absent"))
        assert text.count("Exchange hash") == 2
        assert text.count("Join") == 1


def test_small_source_leaves_the_target_in_place(spark, tables):
    target, rows = tables
    with settings(spark, **NO_BROADCAST):
        text = plan(
            upsert(target, rows, KEYS, ["a"], ["k", "r", "a"], small_source=True, null_keys="absent")
        )
        assert "SortMergeJoin" not in text
        assert depth_of(text, "/target]") == 0


def test_hot_key_is_combined_before_the_shuffle(spark, tables):
    _, rows = tables
    df = collapse(rows, KEYS, insert_only=["a"], updated=["b"])
    text = plan(df)
    below = text[text.index("Exchange hash"):]
    assert "partial_min" in below and "partial_max" in below


def test_hot_key_of_an_insert_only_load_is_split(spark, tables):
    target, rows = tables
    with settings(spark, **SPLIT):
        loaded = insert_new(target, rows, KEYS, ["k", "r", "a", "b"], null_keys="absent", distinct=False)
        text = final_plan(loaded.duplicates)
        assert "skew=true" in text and "Window" not in text
        assert loaded.duplicates.count() == 20_000 - 1


def test_hot_key_of_an_update_is_split(spark, tables):
    _, rows = tables
    flags = rows.select("k", F.lit("flag").alias("b"))
    with settings(spark, **SPLIT):
        df = update_by_key(rows, flags, ["k"], ["b"])
        assert "skew=true" in final_plan(df)
        assert df.where("b = 'flag'").count() == 60_000


def test_hot_message_is_split(spark, tables):
    _, rows = tables
    log = rows.select("k", F.length("a").alias("n"), "a", "b")
    maxima = log.groupBy("k").agg(F.max("n").alias("n"), F.lit(0).cast("long").alias("window"))
    with settings(spark, **SPLIT):
        df = catch_up(log, maxima, item="k", seq="n")
        assert "skew=true" in final_plan(df)
        assert df.count() == 60_000
        df = latest_in_window(log.withColumn("t", F.lit(0)), F.lit(0), F.lit(1), item="k", seq="n", at="t")
        assert "skew=true" in final_plan(df)


def test_hot_item_of_flags_is_split(spark, tables):
    _, rows = tables
    with settings(spark, **SPLIT):
        df = expand_to_keys(rows.select("k", "b"), ["k"], ["b"], rows, keys=["k", "a"])
        assert "skew=true" in final_plan(df)
        assert df.count() == 60_000
