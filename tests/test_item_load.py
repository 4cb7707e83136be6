import random
import tempfile
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import items as I
from goldweave import schema as S
from goldweave.operators.quarantine import max_length
from goldweave.plans.audit import read_audit, step_states
from goldweave.plans.item_load import KEY_RULES, LoadFailed, Paths, run_item_load
from goldweave.sources.snapshot import Store, publish

SYNC = "items"
HOUR = timedelta(hours=1)
START = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def small_session(spark):
    """Wide rows but few of them: compiling the plans would take most of the time."""
    fast = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in fast}
    for k, v in fast.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


class World:
    """Input tables and a store in a folder of their own."""

    def __init__(self, spark, feed=(), messages=(), master=(), control=None, jobs=None, props=None):
        self.spark = spark
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        self.paths = Paths(*[f"{root}/{n}" for n in ("feed", "changes", "jobs", "props", "store", "audit")])
        control = [dict(
            sync_up_id=SYNC, start_time=START, end_time=START + 6 * HOUR,
            sync_up_date=START + 30 * HOUR,
        )] if control is None else control
        jobs = [dict(job_name=SYNC, job_frequency_per_day=Decimal(4))] if jobs is None else jobs
        props = [dict(id="can_update_ent_state", propvalue="Y", sys_ent_state="ACTIVE")] if props is None else props
        self.feed, self.messages, self.master = list(feed), list(messages), list(master)
        for rows, schema, path in (
            (feed, S.FEED_SCHEMA, self.paths.feed),
            (messages, S.MESSAGE_SCHEMA, self.paths.changes),
            (jobs, S.JOB_SCHEMA, self.paths.jobs),
            (props, S.PROPERTY_SCHEMA, self.paths.properties),
        ):
            I.frame(spark, list(rows), schema).write.parquet(path)
        self.store = Store(spark, self.paths.store)
        publish(I.frame(spark, self.master, S.MASTER_SCHEMA), self.store, "mst_item", "seed-m")
        publish(I.frame(spark, control, S.CONTROL_SCHEMA), self.store, "aif_last_sync_up", "seed-c")

    def run(self, **options):
        options = {"run_ts": I.RUN_TS, "run_user": I.USER} | options
        return run_item_load(self.spark, self.paths, "S1", SYNC, **options)

    def result(self):
        return [r.asDict() for r in self.store.read("mst_item", S.MASTER_SCHEMA).collect()]

    def rejects(self):
        return [r.asDict() for r in self.store.read_all("err_item", S.REJECT_SCHEMA).collect()]

    def control(self):
        return self.store.read("aif_last_sync_up", S.CONTROL_SCHEMA).first()


def random_world(spark, seed):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    feed = [
        I.feed_row(
            item_id=pick("A", "B", "C", "D", None), revision=pick(" ", "1"),
            sys_source=pick("S1", "S1", "S2"), sys_ent_state=pick("ACTIVE", "ACTIVE", "DELETED"),
            name=pick(None, "n1", "n2"), description=pick(None, "d1", "d2"),
            commodity_code=pick(None, "  ", " c ", "c"), commodity_id=pick(None, "i1", "i2"),
            eol_date=pick(None, "", "2024-01-02 03:04:05 -05:00", "2024-1-2 3:04:05 +05:30"),
            height=pick(None, Decimal("1.5"), Decimal("2")), is_emc=pick(None, "Y", "N"),
            part_type=pick(None, "t1", "t2"), hazard=pick(None, "Y"),
            sys_created_by=pick("u1", "u2"), sys_last_modified_by=pick("u1", "u2"),
            transaction_seq=rng.randrange(100),
        )
        for _ in range(16)
    ]
    messages = [
        I.message(
            item=pick("A", "B", "E", "F", None), seq_num=rng.randrange(5),
            item_description=pick(None, "m1", "m2"), part_type=pick(None, "t8", "t9"),
            iso_ctry_code=pick(None, "US", "DE"),
            sys_creation_date=START + rng.choice([0, 3, 6, 7, 12, 15, 18, 24, 30, 40]) * HOUR,
        )
        for _ in range(24)
    ]
    master = [
        I.master_row(item_id=k, revision=r, name="old", description="old", part_type="old",
                     hazard="old", fga_iso_ctry_code="old", is_emc="old", sys_source=pick("S1", "S2"))
        for k in ("A", "C", "F") for r in (" ", "1", "2") if rng.random() < 0.6
    ]
    return World(spark, feed, messages, master)


def due(n):
    return [(START + 6 * k * HOUR, START + 6 * (k + 1) * HOUR) for k in range(n)]


@pytest.mark.parametrize("mode", ["A", "B", "C"])
@pytest.mark.parametrize("seed,small", [(1, True), (2, False), (3, False)])
def test_against_row_by_row(spark, monkeypatch, mode, seed, small):
    monkeypatch.setattr("goldweave.plans.item_load.fits_in_memory", lambda *s: small)
    w = random_world(spark, seed)
    result = w.run(mode=mode)
    # ends at 6, 12, 18 h: the last is two strides before the sync at 30 h
    expected = I.load(w.master, w.feed, w.messages, due(3), mode=mode)
    assert I.comparable(w.result()) == I.comparable(expected)
    assert (result.code, result.message) == (0, "SUCCESS")
    mine = [f for f in w.feed if f["sys_source"] == "S1"]
    keyless = [f for f in mine if f["item_id"] is None]
    assert result.counts["in_rows"] == len(mine)
    rejects = w.rejects()
    assert len([r for r in rejects if r["step"] == "feed"]) == len(keyless)
    if mode != "C":
        columns = S.FEED_COLUMNS
        distinct = {tuple(I.normal(f)[c] for c in columns) for f in mine if f["item_id"]}
        assert result.counts["feed_merged"] == len(distinct)
    else:
        distinct = {tuple(I.normal(f)[c] for c in S.FEED_COLUMNS) for f in mine if f["item_id"]}
        known = {(m["item_id"], m["revision"]) for m in w.master}
        new = [d for d in distinct if d[:2] not in known]
        assert result.counts["feed_inserted"] == len({d[:2] for d in new})
        assert len([r for r in rejects if r["step"] == "duplicates"]) == len(new) - len({d[:2] for d in new})
    added = len(expected) - len(w.master)
    assert sum(v for k, v in result.counts.items() if k.endswith("_inserted")) == added


def test_control_and_audit(spark):
    w = random_world(spark, 4)
    w.run(job_instance_id="i7")
    c = w.control()
    assert (c.start_time, c.end_time) == (START + 18 * HOUR, START + 24 * HOUR)
    assert c.sync_up_date == I.RUN_TS and c.operation_status == "SUCCESS" and c.instance_id == "i7"
    assert c.operation_code == max(f["transaction_seq"] for f in w.feed if f["sys_source"] == "S1")
    states = {r.step_type: r for r in step_states(read_audit(spark, w.paths.audit)).collect()}
    assert states["MERGE"].status == "UPDATE SUCCEEDED" and states["MERGE"].ended_at is not None
    assert states["UPDATE_SYNCUP"].status == "UPDATE SUCCEEDED2024-01-03 10:00:00:items"


def test_run_twice_changes_only_stamps(spark):
    w = random_world(spark, 5)
    w.run()
    once = I.comparable(w.result())
    # the windows have moved on; start them again
    control = w.store.read("aif_last_sync_up", S.CONTROL_SCHEMA).withColumns(
        {"start_time": F.lit(START), "end_time": F.lit(START + 6 * HOUR),
         "sync_up_date": F.lit(START + 30 * HOUR)}
    )
    publish(control, w.store, "aif_last_sync_up", "again")
    w.run(run_ts=I.RUN_TS + HOUR)
    twice = w.result()
    for r in twice:
        if r["sys_last_modified_date"] == I.RUN_TS + HOUR:
            r["sys_last_modified_date"] = I.RUN_TS
    assert I.comparable(twice) == once


def test_message_then_feed_on_no_revision(spark):
    w = World(
        spark,
        feed=[I.feed_row(item_id="A", name="n", description="e")],
        messages=[I.message(item="A", seq_num=1, item_description="d", sys_creation_date=START),
                  I.message(item="B", seq_num=1, item_description="b", sys_creation_date=START)],
    )
    w.run()
    rows = {r["item_id"]: r for r in w.result()}
    assert (rows["A"]["name"], rows["A"]["description"]) == ("n", "d")
    b = rows["B"]
    assert (b["revision"], b["name"], b["item_type"], b["sys_ent_state"]) == (" ", "b", "PART", "ACTIVE")
    assert b["sys_created_by"] == b["sys_last_modified_by"] == I.USER


def test_first_row_rejected(spark):
    w = World(spark, feed=[
        I.feed_row(item_id="A", revision="1", commodity_code="a", description="too long", name="x"),
        I.feed_row(item_id="A", revision="1", commodity_code="b", description="d2", name="y"),
    ])
    w.run(feed_rules=[*KEY_RULES, max_length(12899, "description", 5)])
    (row,) = w.result()
    assert (row["description"], row["name"]) == ("d2", "y")
    (bad,) = w.rejects()
    assert (bad["sys_err_code"], bad["name"], bad["sys_nc_type"]) == (12899, "x", "INSERT")
    assert bad["step"] == "feed" and "longer" in bad["sys_err_mesg"]


def test_bad_date_aborts_or_rejects(spark):
    feed = [I.feed_row(item_id="A", eol_date="bad"), I.feed_row(item_id="B")]
    w = World(spark, feed=feed)
    with pytest.raises(LoadFailed, match="eol_date"):
        w.run(run_id="r1")
    assert w.result() == [] and w.rejects() == []
    states = step_states(read_audit(spark, w.paths.audit)).collect()
    assert [s.status.startswith("ERROR") for s in states] == [True]
    w.run(run_id="r2", bad_dates="reject")
    assert [r["item_id"] for r in w.result()] == ["B"]
    assert [(r["item_id"], r["eol_date"]) for r in w.rejects()] == [("A", "bad")]


def test_empty_feed_closes_the_control_row(spark):
    w = World(spark)
    w.run()
    c = w.control()
    assert (c.operation_status, c.operation_code) == ("SUCCESS", 0)


def test_flags_and_deletes_cross_sources(spark):
    w = World(
        spark,
        feed=[I.feed_row(item_id="A", revision="1", is_emc="Y"),
              I.feed_row(item_id="B", revision="1", sys_source="S2", sys_ent_state="DELETED")],
        master=[I.master_row(item_id="A", revision="2", sys_source="S9"),
                I.master_row(item_id="B", revision="1", sys_ent_state="ACTIVE")],
    )
    w.run()
    rows = {(r["item_id"], r["revision"]): r for r in w.result()}
    assert {(r["is_emc"], r["sys_source"]) for k, r in rows.items() if k[0] == "A"} == {("Y", "S1")}
    assert rows["B", "1"]["sys_ent_state"] == "DELETED"


def test_deletes_are_gated(spark):
    w = World(
        spark,
        feed=[I.feed_row(item_id="B", sys_source="S2", sys_ent_state="DELETED")],
        master=[I.master_row(item_id="B", sys_ent_state="ACTIVE")],
        props=[dict(id="can_update_ent_state", propvalue="N", sys_ent_state="ACTIVE")],
    )
    w.run()
    assert w.result()[0]["sys_ent_state"] == "ACTIVE"


CONTROL = dict(sync_up_id=SYNC, start_time=START, end_time=START + HOUR, sync_up_date=START)


@pytest.mark.parametrize("tables,match", [
    (dict(control=[]), "none"),
    (dict(control=[CONTROL, CONTROL]), "several"),
    (dict(control=[CONTROL | dict(sync_up_date=None)]), "sync time"),
    (dict(jobs=[dict(job_name=SYNC, job_frequency_per_day=Decimal(0))]), "frequency"),
    (dict(jobs=[dict(job_name=SYNC)]), "frequency"),
    (dict(jobs=[]), "none"),
    (dict(props=[]), "none"),
])
def test_failed_lookups_publish_nothing(spark, tables, match):
    w = World(spark, feed=[I.feed_row(item_id="A")], **tables)
    with pytest.raises(LoadFailed, match=match):
        w.run()
    assert w.result() == []


def test_null_source(spark):
    w = World(spark)
    with pytest.raises(ValueError, match="source"):
        run_item_load(spark, w.paths, "", SYNC, run_ts=I.RUN_TS, run_user=I.USER)


def test_bucketed_master_is_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr("goldweave.plans.item_load.fits_in_memory", lambda *s: False)
    w = random_world(spark, 6)
    w.run(mode="B", buckets=4, run_id="b1")
    assert I.comparable(w.result()) == I.comparable(I.load(w.master, w.feed, [], [], mode="B"))
    w.run(mode="B", buckets=4, run_id="b2", run_ts=I.RUN_TS + HOUR)
    master = w.store.read("mst_item", S.MASTER_SCHEMA)
    sums = master.groupBy(*S.KEYS).count()
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
