"""What a load broadcasts is bounded by what it measured, not by a caller's word or by file sizes."""

import pytest
from pyspark.sql import functions as F

import items as I
from goldweave import schema as S
from goldweave import session
from goldweave.operators import expand_to_keys
from goldweave.plans import item_load
from goldweave.plans.item_load import LoadInputs, plan_load
from test_item_load import small_session  # noqa: F401
from test_plans import plan


def inputs(spark):
    feed = I.frame(spark, [
        I.feed_row(item_id="a", revision="1", sys_source="S1", name="n"),
        I.feed_row(item_id="b", revision="1", sys_source="S1", name="m"),
    ], S.FEED_SCHEMA)
    master = I.frame(spark, [I.master_row(item_id="a", revision="1", name="o")], S.MASTER_SCHEMA)
    return LoadInputs(
        master=master, feed=feed, source="S1", run_ts=F.lit("2024-02-01 00:00:00").cast("timestamp"),
        run_user="u", mode="B", small=True)


@pytest.mark.parametrize("rows,broadcast", [(1_000_000, True), (1, False)])
def test_sources_called_small_are_measured(spark, monkeypatch, rows, broadcast):
    fits = item_load.fits_in_memory
    monkeypatch.setattr(item_load, "fits_in_memory", lambda *sides: fits(*sides, max_rows=rows))
    with session.load_settings(spark):
        master = plan_load(inputs(spark)).master
        assert ("BroadcastExchange" in plan(master)) == broadcast
        assert sorted((r.item_id, r.name) for r in master.collect()) == [("a", "n"), ("b", "m")]


def test_keys_of_a_wide_table_are_not_taken_for_small(spark):
    """Its files say little of its rows: the keys of all rows were once broadcast."""
    wide = spark.range(200_000).select(
        F.concat(F.lit("item"), F.col("id") % 5000).alias("item_id"), F.col("id").cast("string").alias("revision"),
        *[F.lit(None).cast("string").alias(f"c{k}") for k in range(90)])
    wide = session.staged(wide, "wide")
    flags = spark.range(5000).select(
        F.concat(F.lit("item"), "id").alias("item_id"), F.lit("Y").alias("is_emc"))
    with session.load_settings(spark):
        keyed = expand_to_keys(flags, ["item_id"], ["is_emc"], wide, keys=S.KEYS)
        assert "BroadcastExchange" not in plan(keyed)
        assert keyed.count() == 200_000
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
