"""Scans, projections, scalar expressions, lookups, reject rules, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldweave.checks.registry import query, table
from goldweave.functions import (
    blank_to_null,
    concat_text,
    next_sequence,
    round_to_hour,
    stride_seconds,
    timestamp_text,
)
from goldweave.operators import Rule, castable, max_length, normalize_feed, not_null
from goldweave.operators import project_messages, split_rejects
from goldweave.plans.audit import step_states
from goldweave.plans.control import close_sync
from goldweave.sources import deleted_rows, flag_rows, lookup_one, of_source, source_count


@query(
    "feed_scan",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def feed_scan(spark, d):
    orders = table(spark, d, "orders")
    mine = of_source(orders, "F", "o_orderstatus")
    return mine.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("feed_count", "SELECT count(*) AS in_rows FROM lineitem WHERE l_returnflag = 'R'")
def feed_count(spark, d):
    return source_count(of_source(table(spark, d, "lineitem"), "R", "l_returnflag"))


@query(
    "deleted_rows",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM "
    "(SELECT *, CASE WHEN l_linestatus = 'F' THEN 'DELETED' ELSE 'ACTIVE' END AS st FROM lineitem) "
    "WHERE st = 'DELETED'",
)
def deleted(spark, d):
    state = F.when(F.col("l_linestatus") == "F", "DELETED").otherwise("ACTIVE")
    feed = table(spark, d, "lineitem").withColumn("sys_ent_state", state)
    return deleted_rows(feed).select("l_orderkey", "l_linenumber", "l_returnflag")


@query(
    "flag_rows",
    "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'N'",
)
def flags(spark, d):
    mine = of_source(table(spark, d, "lineitem"), "N", "l_returnflag")
    return flag_rows(mine, "l_partkey", ["l_returnflag", "l_linestatus"])


@query(
    "feed_normalize",
    "SELECT DISTINCT c_nationkey, "
    "nullif(trim(CASE WHEN c_acctbal < 0 THEN '   ' ELSE '  ' || c_mktsegment || ' ' END), '') "
    "AS c_mktsegment FROM customer",
)
def feed_normalize(spark, d):
    padded = F.when(F.col("c_acctbal") < 0, "   ").otherwise(
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    )
    feed = table(spark, d, "customer").withColumn("c_mktsegment", padded)
    return normalize_feed(
        feed, ["c_nationkey", "c_mktsegment"], trimmed=["c_mktsegment"], dates=[]
    )


@query(
    "parse_offset_ts",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL "
    "WHEN o_orderstatus = 'O' THEN o_orderdate - INTERVAL 330 MINUTE "
    "ELSE o_orderdate + INTERVAL 5 HOUR END AS ordered_at FROM orders",
)
def parse_offset(spark, d):
    offset = F.when(F.col("o_orderstatus") == "O", " +05:30").otherwise(" -05:00")
    text = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.concat(timestamp_text("o_orderdate"), offset)
    )
    feed = table(spark, d, "orders").withColumn("ordered_at", text)
    return normalize_feed(
        feed, ["o_orderkey", "ordered_at"], trimmed=[], dates=["ordered_at"], distinct=False
    )


@query(
    "message_projection",
    "SELECT DISTINCT user_id AS item_id, event_type AS description, "
    "CASE WHEN event_type = 'error' THEN NULL ELSE 'T' END AS part_type FROM events",
)
def message_projection(spark, d):
    messages = table(spark, d, "events").withColumn(
        "kind", F.when(F.col("event_type") != "error", "T")
    )
    return project_messages(
        messages, {"user_id": "item_id", "event_type": "description", "kind": "part_type"}
    )


@query(
    "scalar_functions",
    "SELECT event_id, "
    "date_trunc('hour', ts + INTERVAL 30 MINUTE) AS rounded, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS txt, "
    "'user ' || coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, '') || ':' "
    "|| CAST(user_id AS VARCHAR) AS label, "
    "nullif(trim(CASE WHEN event_type = 'view' THEN '  ' ELSE ' ' || event_type END), '') AS kind, "
    "CAST(CASE WHEN user_id IS NULL OR user_id = 7 THEN 0 ELSE user_id END AS BIGINT) AS seq, "
    "CAST(round(86400.0 / (user_id + 1)) AS BIGINT) AS stride FROM events",
)
def scalar_functions(spark, d):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    padded = F.when(F.col("event_type") == "view", "  ").otherwise(
        F.concat(F.lit(" "), "event_type")
    )
    return table(spark, d, "events").select(
        "event_id",
        round_to_hour("ts").alias("rounded"),
        timestamp_text("ts").alias("txt"),
        concat_text(F.lit("user "), kind, F.lit(":"), F.col("user_id").cast("string")).alias("label"),
        blank_to_null(padded).alias("kind"),
        next_sequence("user_id", limit=7).cast("long").alias("seq"),
        stride_seconds(F.col("user_id") + 1).alias("stride"),
    )


_RULES = (
    not_null(1400, "quality"),
    max_length(12899, "text", 2000),
    castable(1722, "code", "decimal(38,10)"),
    Rule(2290, "source is not allowed", "source LIKE '%1'"),
)
_DOCUMENTS = (
    "SELECT d.doc_id, d.text, d.lang, d.source, "
    "CASE WHEN d.lang = 'fr' THEN NULL ELSE d.n_chars END AS quality, "
    "CASE WHEN d.lang = 'de' THEN 'n/a' ELSE CAST(d.n_chars AS VARCHAR) END AS code FROM documents d"
)


def _documents(spark, d):
    return table(spark, d, "documents").withColumns(
        {
            "quality": F.when(F.col("lang") != "fr", F.col("n_chars")),
            "code": F.when(F.col("lang") == "de", "n/a").otherwise(F.col("n_chars").cast("string")),
        }
    )


@query(
    "reject_rules",
    "SELECT doc_id, CAST(CASE WHEN r1 THEN 1400 WHEN r2 THEN 12899 WHEN r3 THEN 1722 ELSE 2290 END "
    "AS BIGINT) AS sys_err_code, "
    "concat_ws('; ', CASE WHEN r1 THEN 'quality is missing' END, "
    "CASE WHEN r2 THEN 'text is longer than 2000' END, "
    "CASE WHEN r3 THEN 'code is not a decimal(38,10)' END, "
    "CASE WHEN r4 THEN 'source is not allowed' END) AS sys_err_mesg FROM "
    "(SELECT *, quality IS NULL AS r1, length(text) > 2000 AS r2, code = 'n/a' AS r3, "
    f"source LIKE '%1' AS r4 FROM ({_DOCUMENTS})) WHERE r1 OR r2 OR r3 OR r4",
)
def reject_rules(spark, d):
    _, rejected = split_rejects(_documents(spark, d), _RULES)
    return rejected.select("doc_id", "sys_err_code", "sys_err_mesg")


@query(
    "accepted_rows",
    f"SELECT doc_id, lang, source, quality FROM ({_DOCUMENTS}) WHERE quality IS NOT NULL "
    "AND length(text) <= 2000 AND code <> 'n/a' AND source NOT LIKE '%1'",
)
def accepted_rows(spark, d):
    accepted, _ = split_rejects(_documents(spark, d), _RULES)
    return accepted.select("doc_id", "lang", "source", "quality")


@query(
    "lookup_one",
    "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = "
    "(SELECT r_regionkey FROM region WHERE r_name = 'ASIA')",
)
def lookup(spark, d):
    region = lookup_one(table(spark, d, "region"), F.col("r_name") == "ASIA", ["r_regionkey"])
    nation = table(spark, d, "nation").where(F.col("n_regionkey") == region["r_regionkey"])
    return nation.select("n_nationkey", "n_name")


@query(
    "sync_close",
    "WITH s AS (SELECT l_returnflag AS id, max(l_orderkey) AS m FROM lineitem GROUP BY 1) "
    "SELECT id AS sync_up_id, CASE WHEN id = 'R' THEN TIMESTAMP '2024-01-03 10:00:00' END AS "
    "sync_up_date, CAST(CASE WHEN id = 'R' THEN m END AS BIGINT) AS operation_code, "
    "CASE WHEN id = 'R' THEN 'SUCCESS' END AS operation_status, "
    "CASE WHEN id = 'R' THEN 'i1' END AS instance_id FROM s",
)
def sync_close(spark, d):
    lines = table(spark, d, "lineitem")
    control = lines.select(F.col("l_returnflag").alias("sync_up_id")).distinct().select(
        "sync_up_id",
        F.lit(None).cast("timestamp").alias("sync_up_date"),
        F.lit(None).cast("long").alias("operation_code"),
        F.lit(None).cast("string").alias("operation_status"),
        F.lit(None).cast("string").alias("instance_id"),
    )
    run_ts = F.lit("2024-01-03 10:00:00.25").cast("timestamp")
    mine = of_source(lines, "R", "l_returnflag")
    return close_sync(control, mine, "R", run_ts, "i1", sequence="l_orderkey")


@query(
    "sequence_wrap",
    "SELECT l_returnflag, CAST(CASE WHEN m = t THEN 0 ELSE m END AS BIGINT) AS next_seq FROM "
    "(SELECT l_returnflag, max(l_orderkey) AS m FROM lineitem GROUP BY 1) "
    "CROSS JOIN (SELECT max(l_orderkey) AS t FROM lineitem)",
)
def sequence_wrap(spark, d):
    """The highest number of all is the limit, so that it wraps at every scale."""
    lines = table(spark, d, "lineitem")
    limit = lines.agg(F.max("l_orderkey")).first()[0]
    return lines.groupBy("l_returnflag").agg(
        next_sequence(F.max("l_orderkey"), limit=limit).cast("long").alias("next_seq")
    )


_AUDIT = (
    "SELECT user_id AS run_id, event_id // 2 AS step_id, ts AS at_, "
    "CASE WHEN event_type = 'view' THEN 'open' ELSE 'close' END AS event, "
    "CASE WHEN event_type = 'view' THEN 'STARTED' ELSE event_type END AS status, "
    "CASE WHEN event_type = 'view' THEN 'step of ' || CAST(user_id AS VARCHAR) END AS txt, "
    "event_id AS rows_in FROM events"
)


@query(
    "audit_trail",
    f"WITH e AS ({_AUDIT}), r AS (SELECT *, row_number() OVER (PARTITION BY run_id, step_id "
    "ORDER BY at_ DESC, event ASC) AS rank_ FROM e), "
    "g AS (SELECT run_id, step_id, max(txt) AS txt, min(at_) AS started_at, "
    "max(CASE WHEN event = 'close' THEN at_ END) AS ended_at FROM e GROUP BY 1, 2) "
    "SELECT g.run_id, g.step_id, g.txt AS text, r.status, r.rows_in, g.started_at, g.ended_at "
    "FROM g JOIN r ON g.run_id = r.run_id AND g.step_id = r.step_id AND r.rank_ = 1",
)
def audit_trail(spark, d):
    opens = F.col("event_type") == "view"
    none = F.lit(None).cast("long")
    audit = table(spark, d, "events").select(
        F.col("user_id").alias("run_id"),
        F.expr("event_id div 2").alias("step_id"),
        F.col("ts").alias("at"),
        F.when(opens, "open").otherwise("close").alias("event"),
        F.lit("MERGE").alias("step_type"),
        F.when(opens, "STARTED").otherwise(F.col("event_type")).alias("status"),
        F.when(opens, concat_text(F.lit("step of "), F.col("user_id").cast("string"))).alias("text"),
        F.col("event_id").alias("rows_in"),
        *[none.alias(c) for c in ("rows_merged", "rows_inserted", "rows_updated", "rows_rejected")],
    )
    columns = ["run_id", "step_id", "text", "status", "rows_in", "started_at", "ended_at"]
    return step_states(audit).select(*columns)
