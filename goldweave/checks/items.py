"""The whole item load, in its three modes, on tables derived from orders, lines and events.

The expressions below are plain SQL that Spark and the checking engine read alike.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from goldweave import schema as S
from goldweave import session
from goldweave.checks.incremental import DUE, windows
from goldweave.checks.registry import SqlSource, merge_sql, query, schema_of, table
from goldweave.operators.normalize import normalize_feed
from goldweave.operators.quarantine import as_rejects, not_null
from goldweave.plans.item_load import FEED as FEED_STEP
from goldweave.plans.item_load import MESSAGES as MESSAGE_STEP
from goldweave.plans.item_load import (
    CONTROL_TABLE,
    DELETE_PROPERTY,
    DUPLICATES,
    FLAGS,
    KEY_RULES,
    MASTER_TABLE,
    LoadInputs,
    Paths,
    caught_up,
    load_outcome,
    plan_load,
    reject_constants,
    run_item_load,
)
from goldweave.sources.snapshot import AlreadyCommitted, Layout, Store, append_rejects, publish
from goldweave.sources.tables import of_source
from goldweave.streaming.catchup import start_catch_up, start_state_catch_up

USER, SOURCE = "loader", "R"
_RUN = "TIMESTAMP '2024-02-01 00:00:00'"

_NO_TEXT = "CAST(NULL AS STRING)"
_NO_TIME = "CAST(NULL AS TIMESTAMP)"
_NO_MEASURE = "CAST(NULL AS DECIMAL(38,10))"


def _feed_expressions() -> dict[str, str]:
    e = {c: _NO_TEXT for c in S.FEED_COLUMNS} | {c: _NO_MEASURE for c in S.MEASURES}
    e.update(
        item_id="CAST(l_partkey AS STRING)",
        revision="CASE WHEN l_linenumber = 1 THEN ' ' ELSE CAST(l_linenumber AS STRING) END",
        sys_source="l_returnflag",
        sys_ent_state="CASE WHEN l_linestatus = 'F' AND l_quantity > 40 THEN 'DELETED' ELSE 'ACTIVE' END",
        name="concat('n', CAST(l_suppkey AS STRING))",
        description="concat('d', CAST(l_orderkey AS STRING))",
        commodity_code="CASE WHEN l_discount < 0.02 THEN '  ' ELSE concat(' c', CAST(l_suppkey AS STRING), ' ') END",
        commodity_id="concat('k', CAST(l_suppkey AS STRING))",
        part_type="CASE WHEN l_tax > 0.06 THEN NULL ELSE l_linestatus END",
        part_class="l_linestatus",
        item_type="'FEED'",
        is_emc="CASE WHEN l_tax > 0.04 THEN 'Y' WHEN l_tax > 0.02 THEN 'N' ELSE NULL END",
        hazard="CASE WHEN l_discount > 0.05 THEN NULL ELSE 'Y' END",
        sys_created_by="concat('u', CAST(l_linenumber AS STRING))",
        sys_last_modified_by="concat('v', CAST(l_linenumber AS STRING))",
        list_price="CAST(l_extendedprice AS DECIMAL(38,10))",
        min_qty="CAST(l_quantity AS DECIMAL(38,10))",
    )
    shipped = "substr(CAST(l_shipdate AS STRING), 1, 10)"
    e.update(
        eol_date=f"CASE WHEN l_discount < 0.01 THEN '' ELSE concat({shipped}, ' 00:00:00 -05:00') END",
        setup_date=f"concat({shipped}, ' 0:0:0 +05:30')",
    )
    # every remaining code has a value of its own, so that a column put in the wrong place shows
    e.update({c: f"'{c}'" for c in S.CODES if e[c] == _NO_TEXT})
    return e


FEED = _feed_expressions()
# what the dates parse to
PARSED = {
    "eol_date": "CASE WHEN l_discount < 0.01 THEN NULL ELSE l_shipdate + INTERVAL 5 HOUR END",
    "setup_date": "l_shipdate - INTERVAL 330 MINUTE",
}

MESSAGES = {c: _NO_TEXT for c in S.MESSAGE_TO_MASTER} | {c: _NO_TIME for c in S.MESSAGE_DATES}
MESSAGES.update(
    item="CAST(user_id AS STRING)",
    item_description="concat('m', event_type)",
    part_type="CASE WHEN event_type = 'view' THEN NULL ELSE event_type END",
    part_class="event_type",
    iso_ctry_code="CASE WHEN value > 10 THEN 'US' ELSE NULL END",
    technical_vendor="props",
    life_cycle_rev_date="ts",
    seq_num="CAST(hour(ts) AS BIGINT)",
    sys_creation_date="ts",
)

MASTER = {c: _NO_TEXT for c in S.MASTER_COLUMNS}
MASTER |= {c: _NO_MEASURE for c in S.MEASURES}
MASTER |= {c: _NO_TIME for c in [*S.OFFSET_DATES, *S.STAMPS, *S.MESSAGE_DATES]}
MASTER.update(
    item_id="CAST(o_custkey AS STRING)",
    revision="CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END",
    name="o_orderpriority",
    description="o_orderstatus",
    fga_iso_ctry_code="'OLD'",
    is_emc="'O'",
    sys_source="o_orderstatus",
    sys_creation_date="o_orderdate",
    sys_created_by="'old'",
)
# parts are the rows without a revision that messages and feed rows meet
PART_MASTER = MASTER | dict(
    item_id="CAST(p_partkey AS STRING)", revision="' '", name="p_name", description="p_type",
    part_type="'OLD'", part_class="'OLD'", sys_source="p_brand", sys_creation_date=_NO_TIME,
    list_price="CAST(p_retailprice AS DECIMAL(38,10))",
)


def _list(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in expressions.items())


_FEED_SQL = f"SELECT {_list(FEED)} FROM lineitem"


def _parsed_sql(source: str) -> str:
    return "SELECT DISTINCT " + _list(
        FEED
        | {c: _NO_TIME for c in S.OFFSET_DATES}
        | PARSED
        | {c: f"nullif(trim({FEED[c]}), '')" for c in S.TRIMMED}
    ) + f" FROM lineitem WHERE l_returnflag = '{source}'"


_PARSED_SQL = _parsed_sql(SOURCE)
_MASTER_SQL = (
    f"SELECT {_list({c: MASTER[c] for c in S.MASTER_COLUMNS})} FROM orders UNION ALL "
    f"SELECT {_list({c: PART_MASTER[c] for c in S.MASTER_COLUMNS})} FROM part"
)
_LOG = f"SELECT {_list(MESSAGES)} FROM events"
_WON = (
    f"SELECT w.win, ' ' AS revision, x.item_description AS name, "
    + ", ".join(f"x.{a} AS {b}" for a, b in S.MESSAGE_TO_MASTER.items())
    + f" FROM (SELECT d.win, l.item, max(l.seq_num) AS seq_num FROM ({DUE}) d JOIN ({_LOG}) l "
    "ON l.sys_creation_date BETWEEN d.s AND d.e GROUP BY 1, 2) w "
    f"JOIN ({_LOG}) x ON x.item = w.item AND x.seq_num = w.seq_num"
)
_STAMPS = {c: _RUN for c in S.STAMPS}


def load_sql(
    mode: str, source: str = SOURCE, delete: bool = True, master: str = _MASTER_SQL, feed: bool = True
) -> str:
    update, insert = {
        "A": (S.FEED_A_UPDATE, S.FEED_A_INSERT),
        "B": (S.FEED_B_UPDATE, S.FEED_B_INSERT),
        "C": ([], S.FEED_C_INSERT),
    }[mode]
    sources = []
    if mode == "A":
        constants = {
            "item_type": "'PART'", "sys_ent_state": "'ACTIVE'", "sys_created_by": f"'{USER}'",
            "sys_last_modified_by": f"'{USER}'", **_STAMPS,
        }
        sources.append(
            SqlSource("b", _WON, S.MESSAGE_UPDATE, S.MESSAGE_INSERT, constants, ["win"], ["win"])
        )
    sources += [
        SqlSource("f", _parsed_sql(source), update, insert, _STAMPS),
        SqlSource(
            "g", f"SELECT item_id, is_emc FROM ({_FEED_SQL}) WHERE sys_source = '{source}'",
            ["is_emc", "sys_source", S.MODIFIED], (),
            {"sys_source": f"'{source}'", S.MODIFIED: _RUN}, keys=["item_id"],
        ),
        SqlSource(
            "x", f"SELECT item_id, revision FROM ({_FEED_SQL}) WHERE sys_ent_state = 'DELETED'",
            ["sys_ent_state", S.MODIFIED], (),
            {"sys_ent_state": "'DELETED'", S.MODIFIED: _RUN},
        ),
    ]
    if not delete:
        sources.pop()
    if not feed:
        sources = sources[:1]
    casts = {c: "DOUBLE" for c in S.MEASURES}
    return merge_sql(master, sources, S.KEYS, S.MASTER_COLUMNS, casts)


def _inputs(spark, d, mode: str, small: bool = False) -> LoadInputs:
    feed = table(spark, d, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in FEED.items()])
    part = table(spark, d, "part").selectExpr(*[f"{PART_MASTER[c]} AS {c}" for c in S.MASTER_COLUMNS])
    orders = table(spark, d, "orders").selectExpr(*[f"{MASTER[c]} AS {c}" for c in S.MASTER_COLUMNS])
    log = table(spark, d, "events").selectExpr(*[f"{e} AS {c}" for c, e in MESSAGES.items()])
    return LoadInputs(
        master=orders.unionByName(part),
        feed=feed,
        source=SOURCE,
        run_ts=F.lit("2024-02-01 00:00:00").cast("timestamp"),
        run_user=USER,
        mode=mode,
        messages=caught_up(log, windows(spark, d)) if mode == "A" else None,
        small=small,
        stage=True,
    )


def _load(mode: str):
    @query(f"item_load_{mode.lower()}", load_sql(mode))
    def run(spark, d):
        return plan_load(_inputs(spark, d, mode)).master.select(*S.MASTER_COLUMNS)

    return run


for _mode in ("A", "B", "C"):
    _load(_mode)


@query("item_load_a_small", load_sql("A"))
def item_load_a_small(spark, d):
    """The plan for small sources; the outcome is the same."""
    return plan_load(_inputs(spark, d, "A", small=True)).master.select(*S.MASTER_COLUMNS)


class _World:
    """The job's inputs as Parquet folders, and its store with the master of before."""

    def __init__(self, spark, d, can_delete: str = "Y"):
        folder = session.scratch(spark, "job")
        self.spark = spark
        self.paths = Paths(*[f"{folder}/{n}" for n in (
            "feed", "changes", "jobs", "properties", "store", "audit")])
        inputs = _inputs(spark, d, "B")
        typed(inputs.feed, S.FEED_SCHEMA).write.options(**session.READ_WHOLE).parquet(self.paths.feed)
        log = table(spark, d, "events").selectExpr(*[f"{e} AS {c}" for c, e in MESSAGES.items()])
        typed(log, S.MESSAGE_SCHEMA).write.parquet(self.paths.changes)
        one = spark.range(1)
        typed(one.selectExpr("'s' AS job_name", "4 AS job_frequency_per_day"), S.JOB_SCHEMA) \
            .write.parquet(self.paths.jobs)
        typed(one.selectExpr(f"'{DELETE_PROPERTY}' AS id", f"'{can_delete}' AS propvalue",
                             "'ACTIVE' AS sys_ent_state"), S.PROPERTY_SCHEMA) \
            .write.parquet(self.paths.properties)
        control = table(spark, d, "events").groupBy().agg(F.max("ts").alias("sync_up_date")).selectExpr(
            "'s' AS sync_up_id", "TIMESTAMP '2024-01-01 00:00:00' AS start_time",
            "TIMESTAMP '2024-01-01 06:00:00' AS end_time", "sync_up_date")
        self.store = Store(spark, self.paths.store)
        publish(typed(inputs.master, S.MASTER_SCHEMA), self.store, MASTER_TABLE, "seed-master")
        publish(typed(control, S.CONTROL_SCHEMA), self.store, CONTROL_TABLE, "seed-control")

    def run(self, mode: str, source: str = SOURCE, **options):
        return run_item_load(self.spark, self.paths, source, "s", run_ts=datetime(2024, 2, 1),
                             run_user=USER, mode=mode, **options)

    def master(self):
        return self.store.read(MASTER_TABLE, S.MASTER_SCHEMA)


def typed(rows, schema):
    """Rows in a schema; columns they lack are NULL."""
    return rows.selectExpr(*[
        f"CAST({f.name if f.name in rows.columns else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schema.fields])


@query("item_load_run_a", load_sql("A"))
def item_load_run_a(spark, d):
    """The whole job with its lookups, control row, audit and publish, into a bucketed master."""
    w = _World(spark, d)
    w.run("A", buckets=8)
    return w.master()


@query("item_load_run_b", load_sql("B", delete=False))
def item_load_run_b(spark, d):
    """The job where the property does not let it delete, with bad dates as rejects."""
    w = _World(spark, d, can_delete="N")
    w.run("B", bad_dates="reject")
    return w.master()


@query("item_load_run_c", load_sql("C"))
def item_load_run_c(spark, d):
    w = _World(spark, d)
    w.run("C")
    return w.master()


@query("item_load_run_parts", load_sql("B", "A", master=load_sql("B")))
def item_load_run_parts(spark, d):
    """Two loads into a master in parts; the second reads and writes the parts of its items only."""
    w = _World(spark, d)
    w.run("B", parts=32)
    w.run("B", "A", parts=32)
    return w.master()


_FAILED = (
    "SELECT 1 AS code, '{}' AS message, '{}' AS location, false AS published, 0 AS warnings, "
    "CAST(NULL AS BIGINT) AS rows_in, CAST(NULL AS BIGINT) AS rows_merged"
)


@query(
    "load_outcome",
    " UNION ALL ".join([
        f"SELECT 0 AS code, 'SUCCESS' AS message, 'done' AS location, true AS published, 0 AS warnings, "
        f"(SELECT count(*) FROM lineitem WHERE l_returnflag = '{SOURCE}') AS rows_in, "
        f"(SELECT count(*) FROM ({_PARSED_SQL})) AS rows_merged",
        _FAILED.format("run r1 has been committed before", "call"),
        _FAILED.format("a load needs a source", "call"),
        _FAILED.format("frequency of t: expected one row, found none", "lookups"),
    ]),
)
def outcomes(spark, d):
    """A load that is published, the same again, one without a source, one of an unknown job."""
    w = _World(spark, d)
    options = {"run_ts": datetime(2024, 2, 1), "run_user": USER, "mode": "B"}
    calls = [(SOURCE, "s", "r1"), (SOURCE, "s", "r1"), ("", "s", "r2"), (SOURCE, "t", "r3")]
    rows = [load_outcome(spark, w.paths, a, b, run_id=r, **options) for a, b, r in calls]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


@query("item_load_rerun", load_sql("B"))
def item_load_rerun(spark, d):
    """The same load once more is refused, and the master stays as published."""
    w = _World(spark, d)
    w.run("B")
    try:
        w.run("B")
    except AlreadyCommitted:
        return w.master()
    raise AssertionError("a run that was committed ran again")


@query("item_load_two_sources", load_sql("B", "A", master=load_sql("B")))
def item_load_two_sources(spark, d):
    """Two sources under one sync id and time stamp, one after the other."""
    w = _World(spark, d)
    w.run("B")
    w.run("B", "A")
    return w.master()


@query("stream_merge", load_sql("A", feed=False))
def stream_merge(spark, d):
    """Messages into the master by micro-batch."""
    store = Store(spark, session.scratch(spark, "stream"))
    publish(typed(_inputs(spark, d, "B").master, S.MASTER_SCHEMA), store, MASTER_TABLE, "seed")

    def shaped(events):
        return typed(events.selectExpr(*[f"{e} AS {c}" for c, e in MESSAGES.items()]), S.MESSAGE_SCHEMA)

    stream = spark.readStream.schema(schema_of("events")).option("pathGlobFilter", "events.parquet").parquet(d)
    start_catch_up(
        shaped(stream), windows(spark, d), store, lambda: shaped(table(spark, d, "events")), name="m",
        checkpoint=session.scratch(spark, "checkpoint"), run_user=USER,
        run_ts=lambda: F.lit("2024-02-01 00:00:00").cast("timestamp"),
    ).awaitTermination()
    return store.read(MASTER_TABLE, S.MASTER_SCHEMA)


@query("stream_state_merge", load_sql("A", feed=False))
def stream_state_merge(spark, d):
    """The same from the messages that the stream keeps itself, into a master in parts."""
    store, layout = Store(spark, session.scratch(spark, "stream")), Layout(("item_id",), 16)
    seed = typed(_inputs(spark, d, "B").master, S.MASTER_SCHEMA)
    store.commit([store.write_parts(seed, MASTER_TABLE, "seed", layout)], "seed")
    events = spark.readStream.schema(schema_of("events")).option("pathGlobFilter", "events.parquet").parquet(d)
    messages = typed(events.selectExpr(*[f"{e} AS {c}" for c, e in MESSAGES.items()]), S.MESSAGE_SCHEMA)
    start_state_catch_up(
        messages, windows(spark, d), store, name="m", checkpoint=session.scratch(spark, "checkpoint"),
        run_user=USER, run_ts=lambda: F.lit("2024-02-01 00:00:00").cast("timestamp"), layout=layout,
    ).awaitTermination()
    return store.read(MASTER_TABLE, S.MASTER_SCHEMA)


@query(
    "feed_distinct",
    f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in S.MEASURES)}) FROM ({_PARSED_SQL})",
)
def feed_distinct(spark, d):
    """All columns of the feed, each row once: digests first, values for repeated digests."""
    feed = of_source(_inputs(spark, d, "B").feed, SOURCE)
    return normalize_feed(feed, stage=session.staged)


@query(
    "message_rejects",
    "SELECT item AS item_id, ' ' AS revision, item_description AS name, 'PART' AS item_type, "
    f"'ACTIVE' AS sys_ent_state, '{USER}' AS sys_created_by, '{USER}' AS sys_last_modified_by, "
    "CAST(NULL AS VARCHAR) AS sys_source, CAST(1400 AS BIGINT) AS sys_err_code FROM ("
    f"SELECT x.* FROM (SELECT d.win, l.item, max(l.seq_num) AS seq_num FROM ({DUE}) d JOIN ({_LOG}) l "
    "ON l.sys_creation_date BETWEEN d.s AND d.e GROUP BY 1, 2) w "
    f"JOIN (SELECT *, row_number() OVER () AS id FROM ({_LOG})) x ON x.item = w.item AND x.seq_num = w.seq_num "
    "QUALIFY row_number() OVER (PARTITION BY x.id) = 1) WHERE iso_ctry_code IS NULL",
)
def message_rejects(spark, d):
    i = replace(_inputs(spark, d, "A"), message_rules=[not_null(1400, "fga_iso_ctry_code")])
    bad = plan_load(i).rejects[MESSAGE_STEP]
    return as_rejects(bad, MESSAGE_STEP, "r", i.run_ts, reject_constants(MESSAGE_STEP, SOURCE, USER)).select(
        "item_id", "revision", "name", "item_type", "sys_ent_state", "sys_created_by",
        "sys_last_modified_by", "sys_source", "sys_err_code")


@query(
    "flag_rejects",
    f"SELECT item_id, sys_ent_state, '{SOURCE}' AS sys_source, 'flags' AS step FROM ({_FEED_SQL}) "
    f"WHERE sys_source = '{SOURCE}' AND is_emc IS NULL",
)
def flag_rejects(spark, d):
    i = replace(_inputs(spark, d, "B"), flag_rules=[not_null(1400, "is_emc")])
    bad = plan_load(i).rejects[FLAGS]
    return as_rejects(bad, FLAGS, "r", i.run_ts, reject_constants(FLAGS, SOURCE, USER)).select(
        "item_id", "sys_ent_state", "sys_source", "step")


@query(
    "item_load_duplicates",
    f"SELECT item_id, revision, description, sys_err_code FROM (SELECT *, CAST(1 AS BIGINT) AS "
    "sys_err_code, row_number() OVER (PARTITION BY item_id, revision ORDER BY "
    + ", ".join(
        f"{c} ASC NULLS FIRST"
        for c in [c for c in S.FEED_C_INSERT if c not in S.KEYS and c not in S.STAMPS]
        + ["part_type", "part_class"]
    )
    + f") AS n FROM ({_PARSED_SQL}) f WHERE NOT EXISTS (SELECT 1 FROM ({_MASTER_SQL}) m WHERE "
    "m.item_id = f.item_id AND m.revision = f.revision)) WHERE n > 1",
)
def item_load_duplicates(spark, d):
    duplicates = plan_load(_inputs(spark, d, "C")).rejects[DUPLICATES]
    return duplicates.select("item_id", "revision", "description", "sys_err_code")


@query(
    "published_rejects",
    "SELECT item_id, revision, name, eol_date, CAST(1400 AS BIGINT) AS sys_err_code, "
    "'hazard is missing' AS sys_err_mesg, 'INSERT' AS sys_nc_type, sys_source, "
    "sys_ent_state, 'feed' AS step, TIMESTAMP '2024-02-01 00:00:00' AS sys_creation_date "
    f"FROM ({_FEED_SQL}) WHERE sys_source = '{SOURCE}' AND hazard IS NULL",
)
def published_rejects(spark, d):
    """Rejected feed rows in the reject table's shape, written, committed and read back."""
    i = _inputs(spark, d, "B")
    plan = plan_load(replace(i, feed_rules=[*KEY_RULES, not_null(1400, "hazard")]))
    run_id = uuid.uuid4().hex
    store = Store(spark, f"{session.shared_folder(spark)}/goldweave-checks/{run_id}")
    rejects = as_rejects(
        plan.rejects[FEED_STEP], FEED_STEP, run_id, i.run_ts, reject_constants(FEED_STEP, SOURCE, USER))
    store.commit([append_rejects(rejects, store, run_id)], run_id)
    return store.read_all("err_item", S.REJECT_SCHEMA).select(
        "item_id", "revision", "name", "eol_date", "sys_err_code", "sys_err_mesg", "sys_nc_type",
        "sys_source", "sys_ent_state", "step", "sys_creation_date",
    )
