"""Distinct rows by digest, and messages that come too late."""

import os
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import items as I
from goldweave import schema as S
from goldweave import session
from goldweave.operators import Windows, distinct_rows, late_messages
from goldweave.plans.item_load import LATE_TABLE, arrived_late
from goldweave.sources import read_changes
from test_item_load import CONTROL, HOUR, START, World, small_session  # noqa: F401
from test_plans import plan
from test_streaming import us


@pytest.fixture(scope="module")
def wide(spark):
    path = session.scratch(spark, "wide")
    spark.range(6000).selectExpr(
        "nullif(id % 5000, 7) AS a", "if(id < 40, null, repeat(string(id % 5000), 20)) AS b",
        "if(id % 3 = 0, null, 'x') AS c", "if(id % 3 = 0, 'x', null) AS d").write.parquet(path)
    return spark.read.parquet(path)


def test_only_repeated_rows_are_shuffled(spark, wide):
    found = distinct_rows(wide, session.staged)
    text = plan(found)
    # The one exchange is for the rows whose digest came more than once.
    assert text.count("Exchange hash") == 1 and text.count("BroadcastHashJoin") == 2
    assert sorted(map(str, found.collect())) == sorted(map(str, wide.distinct().collect()))


def test_rows_that_share_a_digest_are_compared_by_value(spark, monkeypatch, wide):
    monkeypatch.setattr(
        "goldweave.operators.distinct.digested",
        lambda rows: rows.withColumns({"_digest_a": F.lit(1).cast("long"), "_digest_b": F.lit(2).cast("long")}))
    found = distinct_rows(wide, session.staged)
    assert sorted(map(str, found.collect())) == sorted(map(str, wide.distinct().collect()))


def test_many_repeated_rows_and_none(spark, monkeypatch, wide):
    monkeypatch.setattr("goldweave.operators.distinct.fits_in_memory", lambda *s: False)
    assert distinct_rows(wide, session.staged).count() == wide.distinct().count()
    monkeypatch.undo()
    assert distinct_rows(wide.limit(0), session.staged).count() == 0
    assert distinct_rows(wide.select("d"), session.staged).count() == 2


def test_late_by_window(spark):
    w = Windows(us(START), us(START + 6 * HOUR), 21_600, 3)
    rows = spark.createDataFrame(
        [(0, 1, 17), (1, 1, 19), (2, 6, 19), (3, 6, 25), (4, 13, 31), (5, 30, 99), (6, None, 99), (7, 3, None)],
        "id int, at int, arrived int")

    def hour(c):
        return F.timestamp_micros((F.lit(us(START)) + F.col(c) * 3_600_000_000).cast("long"))

    found = late_messages(rows.withColumn("t", hour("at")), w, hour("arrived"), at="t")
    # The windows end at 6, 12 and 18, and are handled at 18, 24 and 30.
    assert sorted((r.id, r.window) for r in found.collect()) == [(1, 0), (2, 0), (3, 0), (3, 1), (4, 2)]


def put(spark, path, rows, arrived):
    before = set(os.listdir(path)) if os.path.isdir(path) else set()
    I.frame(spark, rows, S.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    for f in set(os.listdir(path)) - before:
        os.utime(f"{path}/{f}", (arrived.timestamp(), arrived.timestamp()))


def test_late_by_the_time_of_the_file(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/log"
    sync = datetime(2024, 1, 2, 6)
    old, new = sync - HOUR, sync + HOUR
    early, on_time = START + HOUR, START + 20 * HOUR
    put(spark, path, [I.message(item="seen", sys_creation_date=early)], old)
    put(spark, path, [I.message(item="late", sys_creation_date=early),
                      I.message(item="next", sys_creation_date=on_time)], new)
    log = read_changes(spark, path, arrived="arrived")
    row = CONTROL | dict(start_time=START + 12 * HOUR, sync_up_date=sync, operation_status="SUCCESS")

    def found(**more):
        late = arrived_late(log, I.frame(spark, [row | more], S.CONTROL_SCHEMA))
        return late if late is None else [r.item for r in late.collect()]

    assert found() == ["late"]
    assert found(sync_up_date=new + HOUR) == []
    assert found(operation_status=None) is None and found(start_time=None) is None


def test_the_load_sets_late_messages_aside(spark):
    w = World(spark, messages=[I.message(item="A", seq_num=1, item_description="a", sys_creation_date=START + HOUR)])
    w.run()
    assert w.control().start_time > START
    # The files of this test are written now, long after the time of that run.
    put(spark, w.paths.changes, [I.message(item="L", seq_num=1, sys_creation_date=START + 2 * HOUR)], datetime.now())
    done = w.run(run_ts=I.RUN_TS + timedelta(hours=1), run_id="again")
    late = w.store.read_all(LATE_TABLE, S.MESSAGE_SCHEMA).collect()
    assert {r.item for r in late} == {"A", "L"} and done.counts["late"] == 2
    assert [r["item_id"] for r in w.result()] == ["A"]
