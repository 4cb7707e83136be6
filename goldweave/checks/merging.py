"""Merges: collapse, upserts, updates, deletes, counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from goldweave import session
from goldweave.checks.registry import SqlSource, merge_sql, query, ranked, table
from goldweave.operators import (
    MergeSource,
    collapse,
    counted,
    expand_to_keys,
    merge,
    merge_counts,
    soft_delete,
    update_by_key,
    upsert,
)
from goldweave.operators.normalize import message_insert_defaults
from goldweave.operators.sizing import fits_in_memory
from goldweave.plans.audit import Audit, read_audit, step_states
from goldweave.sources import lookup_one, of_source, source_count

KEYS = ["item", "line"]
COLUMNS = ["item", "line", "status", "price", "priority", "shipped"]
UPDATE_A = ["status", "price", "shipped"]
UPDATE_B = [*UPDATE_A, "priority"]

_MASTER = (
    "SELECT o_orderkey AS item, 1 AS line, o_orderstatus AS status, o_totalprice AS price, "
    "o_orderpriority AS priority, CAST(NULL AS TIMESTAMP) AS shipped FROM orders"
)
_FEED = (
    "SELECT l_orderkey AS item, l_linenumber AS line, "
    "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus END AS status, "
    "l_extendedprice AS price, l_returnflag AS priority, l_shipdate AS shipped FROM lineitem"
)


def master(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("item"),
        F.lit(1).alias("line"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.lit(None).cast("timestamp").alias("shipped"),
    )


def feed(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("item"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("status"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("priority"),
        F.col("l_shipdate").alias("shipped"),
    )


_PAYLOAD = ["l_shipdate", "l_extendedprice", "l_returnflag", "l_suppkey"]


@query(
    "collapse_first_last",
    "SELECT a.l_orderkey, a.l_shipdate, a.l_extendedprice, z.l_returnflag, z.l_suppkey FROM "
    "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY "
    f"{ranked(_PAYLOAD)}) AS n FROM lineitem) a JOIN "
    "(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY "
    f"{ranked(_PAYLOAD, last=True)}) AS n FROM lineitem) z "
    "ON a.l_orderkey = z.l_orderkey AND a.n = 1 AND z.n = 1",
)
def collapse_first_last(spark, d):
    return collapse(
        table(spark, d, "lineitem"),
        ["l_orderkey"],
        insert_only=_PAYLOAD[:2],
        updated=_PAYLOAD[2:],
    )


@query(
    "upsert_feed_a",
    merge_sql(_MASTER, [SqlSource("f", _FEED, UPDATE_A, COLUMNS)], KEYS, COLUMNS),
)
def upsert_feed_a(spark, d):
    return upsert(master(spark, d), feed(spark, d), KEYS, UPDATE_A, COLUMNS)


@query(
    "upsert_feed_b",
    merge_sql(_MASTER, [SqlSource("f", _FEED, UPDATE_B, COLUMNS)], KEYS, COLUMNS),
)
def upsert_feed_b(spark, d):
    return upsert(master(spark, d), feed(spark, d), KEYS, UPDATE_B, COLUMNS)


_BOM_COLUMNS = [
    "item_id", "revision", "name", "description", "part_type", "item_type", "sys_ent_state",
    "sys_created_by", "sys_creation_date", "sys_last_modified_by", "sys_last_modified_date",
]
_BOM_UPDATE = ["description", "part_type", "sys_last_modified_date"]
_RUN = "TIMESTAMP '2024-01-03 10:00:00'"
_BOM_CONSTANTS = {
    "item_type": "'PART'", "sys_ent_state": "'ACTIVE'", "sys_created_by": "'loader'",
    "sys_creation_date": _RUN, "sys_last_modified_by": "'loader'", "sys_last_modified_date": _RUN,
}


@query(
    "upsert_messages",
    merge_sql(
        "SELECT p_partkey AS item_id, ' ' AS revision, p_name AS name, p_name AS description, "
        "p_type AS part_type, 'OLD' AS item_type, 'ACTIVE' AS sys_ent_state, 'x' AS sys_created_by, "
        "TIMESTAMP '2020-01-01' AS sys_creation_date, 'x' AS sys_last_modified_by, "
        "TIMESTAMP '2020-01-01' AS sys_last_modified_date FROM part",
        [
            SqlSource(
                "b",
                "SELECT l_orderkey AS item_id, ' ' AS revision, "
                "l_returnflag || CAST(l_suppkey AS VARCHAR) AS name, "
                "l_returnflag || CAST(l_suppkey AS VARCHAR) AS description, "
                "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus END AS part_type FROM lineitem",
                _BOM_UPDATE,
                # the message columns, then what only an insert sets
                ["item_id", "part_type", "description", "revision", "name", *_BOM_CONSTANTS],
                _BOM_CONSTANTS,
            )
        ],
        ["item_id", "revision"],
        _BOM_COLUMNS,
    ),
)
def upsert_messages(spark, d):
    old = F.lit("2020-01-01").cast("timestamp")
    parts = table(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"), F.lit(" ").alias("revision"),
        F.col("p_name").alias("name"), F.col("p_name").alias("description"),
        F.col("p_type").alias("part_type"), F.lit("OLD").alias("item_type"),
        F.lit("ACTIVE").alias("sys_ent_state"), F.lit("x").alias("sys_created_by"),
        old.alias("sys_creation_date"), F.lit("x").alias("sys_last_modified_by"),
        old.alias("sys_last_modified_date"),
    )
    text = F.concat("l_returnflag", F.col("l_suppkey").cast("string"))
    messages = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("item_id"), F.lit(" ").alias("revision"),
        text.alias("name"), text.alias("description"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("part_type"),
    )
    constants = message_insert_defaults(F.lit("2024-01-03 10:00:00").cast("timestamp"), "loader")
    return upsert(
        parts, messages, ["item_id", "revision"], _BOM_UPDATE,
        ["item_id", "part_type", "description", "revision", "name", *constants],
        constants=constants,
    )


@query(
    "null_overwrite",
    merge_sql(
        "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier",
        [SqlSource(
            "f",
            "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal < 5000 THEN NULL "
            "ELSE c_acctbal END AS balance FROM customer",
            ["balance"], ["id", "name", "balance"],
        )],
        ["id"], ["id", "name", "balance"],
    ),
)
def null_overwrite(spark, d):
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 5000, F.col("c_acctbal")).alias("balance"),
    )
    return upsert(suppliers, rows, ["id"], ["balance"], ["id", "name", "balance"])


@query(
    "upsert_small_feed",
    merge_sql(
        "SELECT o_orderkey AS id, o_orderstatus AS name, o_totalprice AS balance FROM orders",
        [SqlSource(
            "f",
            "SELECT CASE WHEN s_acctbal < 0 THEN 1000000000 + s_suppkey ELSE s_suppkey END AS id, "
            "s_name AS name, s_acctbal AS balance FROM supplier",
            ["balance"], ["id", "name", "balance"],
        )],
        ["id"], ["id", "name", "balance"],
    ),
)
def upsert_small_feed(spark, d):
    """A feed that is measured first, and broadcast if it is within bounds."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"),
        F.col("o_totalprice").alias("balance"),
    )
    key = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(
        F.when(F.col("s_acctbal") < 0, key + 1000000000).otherwise(key).alias("id"),
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
    )
    return upsert(
        orders, rows, ["id"], ["balance"], ["id", "name", "balance"],
        small_source=fits_in_memory(rows),
    )


_FLAG_COLUMNS = ["item", "line", "order_", "is_emc", "source", "modified"]
_FLAG_MASTER = (
    "SELECT l_partkey AS item, l_linenumber AS line, l_orderkey AS order_, l_linestatus AS is_emc, "
    "l_returnflag AS source, l_shipdate AS modified FROM lineitem"
)
_FLAG_LAST = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY "
    f"{ranked(['is_emc', 'source'], last=True)}) AS n FROM (SELECT DISTINCT o_custkey AS item, "
    "o_orderpriority AS is_emc, o_orderstatus AS source FROM orders)) WHERE n = 1"
)


@query(
    "flag_propagate",
    f"SELECT m.item, m.line, m.order_, CASE WHEN f.item IS NULL THEN m.is_emc ELSE f.is_emc END AS "
    "is_emc, CASE WHEN f.item IS NULL THEN m.source ELSE f.source END AS source, "
    f"CASE WHEN f.item IS NULL THEN m.modified ELSE {_RUN} END AS modified "
    f"FROM ({_FLAG_MASTER}) m LEFT JOIN ({_FLAG_LAST}) f ON m.item = f.item",
)
def flag_propagate(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("item"), F.col("l_linenumber").alias("line"),
        F.col("l_orderkey").alias("order_"), F.col("l_linestatus").alias("is_emc"),
        F.col("l_returnflag").alias("source"), F.col("l_shipdate").alias("modified"),
    )
    flags = table(spark, d, "orders").select(
        F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("is_emc"),
        F.col("o_orderstatus").alias("source"),
    )
    return update_by_key(
        lines, flags, ["item"], ["is_emc", "source"],
        constants={"modified": F.lit("2024-01-03 10:00:00").cast("timestamp")},
    )


@query(
    "flag_keys",
    f"SELECT DISTINCT m.item, m.line, f.is_emc FROM ({_FLAG_MASTER}) m JOIN ({_FLAG_LAST}) f "
    "ON m.item = f.item",
)
def flag_keys(spark, d):
    """The same flags spelled out per full key, as the load uses them."""
    lines = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("item"), F.col("l_linenumber").alias("line")
    )
    flags = table(spark, d, "orders").select(
        F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("is_emc"),
        F.col("o_orderstatus").alias("source"),
    )
    by_key = expand_to_keys(flags, ["item"], ["is_emc", "source"], lines, keys=["item", "line"])
    return by_key.select("item", "line", "is_emc").distinct()


@query(
    "soft_delete",
    f"SELECT m.item, m.line, CASE WHEN x.item IS NULL THEN m.status ELSE 'DELETED' END AS status, "
    f"CASE WHEN x.item IS NULL THEN m.shipped ELSE {_RUN} END AS shipped FROM ({_MASTER}) m LEFT JOIN "
    "(SELECT DISTINCT l_orderkey AS item, l_linenumber AS line FROM lineitem WHERE l_returnflag = 'R') x "
    "ON m.item = x.item AND m.line = x.line",
)
def soft_deletes(spark, d):
    target = master(spark, d).select("item", "line", "status", "shipped")
    # the gate: a property looked up as exactly one row
    on = lookup_one(
        table(spark, d, "region").select(F.lit("Y").alias("propvalue"), "r_name"),
        F.col("r_name") == "ASIA",
        ["propvalue"],
    )
    if on["propvalue"] != "Y":
        return target
    gone = of_source(table(spark, d, "lineitem"), "R", "l_returnflag").select(
        F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("line"),
        F.lit("DELETED").alias("status"),
    )
    return soft_delete(
        target, gone, KEYS, state="status",
        constants={"shipped": F.lit("2024-01-03 10:00:00").cast("timestamp")},
    )


@query(
    "step_counts",
    f"WITH m AS ({_MASTER}), f AS ({_FEED}), k AS (SELECT DISTINCT item, line FROM f) "
    "SELECT (SELECT count(*) FROM f) AS feed_merged, "
    "(SELECT count(*) FROM k LEFT JOIN m USING (item, line) WHERE m.status IS NULL) AS feed_inserted, "
    "(SELECT count(*) FROM k JOIN m USING (item, line)) AS feed_updated",
)
def step_counts(spark, d):
    source = MergeSource("feed", feed(spark, d), update=UPDATE_A, insert=COLUMNS)
    return merge_counts(merge(master(spark, d), [source], KEYS, tally=True), ["feed"])


@query(
    "audit_steps",
    f"WITH m AS ({_MASTER}), f AS ({_FEED}), k AS (SELECT DISTINCT item, line FROM f), "
    "n AS (SELECT count(*) AS n FROM k), u AS (SELECT count(*) AS n FROM k JOIN m USING (item, line)) "
    "SELECT 'MERGE' AS step_type, 'Merge the lines' AS text, 'MERGE SUCCEEDED' AS status, "
    "(SELECT count(*) FROM f) AS rows_in, (SELECT count(*) FROM f) AS rows_merged, "
    "n.n - u.n AS rows_inserted, u.n AS rows_updated FROM n, u",
)
def audit_steps(spark, d):
    """A step opened and closed around a merge, with the counts of what it did."""
    rows = feed(spark, d)
    run_id = uuid.uuid4().hex
    audit = Audit(spark, f"{session.shared_folder(spark)}/goldweave-checks/{run_id}", run_id, None, "s")
    step = audit.start("MERGE", "Merge the lines", source_count(rows).first()["in_rows"])
    source = MergeSource("feed", rows, update=UPDATE_A, insert=COLUMNS)
    merged = merge(master(spark, d), [source], KEYS, tally=True)
    done = merge_counts(merged, ["feed"]).first()
    audit.end(
        step, "MERGE SUCCEEDED", rows_in=done["feed_merged"], rows_merged=done["feed_merged"],
        rows_inserted=done["feed_inserted"], rows_updated=done["feed_updated"],
    )
    columns = ["step_type", "text", "status", "rows_in", "rows_merged", "rows_inserted", "rows_updated"]
    return step_states(read_audit(spark, audit.path)).select(*columns)


@query(
    "observed_counts",
    "SELECT count(*) AS rows_seen, count(*) FILTER (l_quantity > 25) AS deep FROM lineitem",
)
def observed_counts(spark, d):
    """Rows counted while they are written; what the observation says."""
    name = f"lines-{uuid.uuid4().hex}"
    rows, seen = counted(table(spark, d, "lineitem"), name, deep=F.col("l_quantity") > 25)
    rows.write.parquet(session.scratch(spark, "observed"))
    return spark.range(1).select(
        F.lit(seen.get["rows"]).cast("long").alias("rows_seen"), F.lit(seen.get["deep"]).cast("long").alias("deep"))
