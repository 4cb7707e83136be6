"""Insert-only load and published tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from goldweave import session
from goldweave.checks.merging import COLUMNS, KEYS, feed, master
from goldweave.checks.merging import _FEED, _MASTER
from goldweave.checks.registry import crc32_sql, query, ranked
from goldweave.operators import insert_new, upsert
from goldweave.sources import Layout, Store, publish, publish_touched

_PAYLOAD = ["status", "price", "priority", "shipped"]
_NEW = (
    f"SELECT *, row_number() OVER (PARTITION BY item, line ORDER BY {ranked(_PAYLOAD)}) AS n FROM "
    f"(SELECT DISTINCT * FROM ({_FEED})) f WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({_MASTER}) m WHERE m.item = f.item AND m.line = f.line)"
)


@query(
    "insert_new",
    f"SELECT {', '.join(COLUMNS)} FROM ({_NEW}) WHERE n = 1 UNION ALL "
    f"SELECT {', '.join(COLUMNS)} FROM ({_MASTER})",
)
def insert_only(spark, d):
    return insert_new(master(spark, d), feed(spark, d), KEYS, COLUMNS).target


@query("insert_new_rejects", f"SELECT {', '.join(COLUMNS)} FROM ({_NEW}) WHERE n > 1")
def insert_only_rejects(spark, d):
    return insert_new(master(spark, d), feed(spark, d), KEYS, COLUMNS).duplicates


@query(
    "published_master",
    f"SELECT coalesce(m.item, f.item) AS item, coalesce(m.line, f.line) AS line, "
    f"CASE WHEN f.item IS NULL THEN m.price ELSE f.price END AS price FROM ({_MASTER}) m FULL JOIN "
    f"(SELECT item, line, max(price) AS price FROM ({_FEED}) GROUP BY 1, 2) f "
    "ON m.item = f.item AND m.line = f.line",
)
def published_master(spark, d):
    """Two versions published one after the other; the second merges into the first."""
    store = Store(spark, f"{session.shared_folder(spark)}/goldweave-checks/{uuid.uuid4().hex}")
    first = master(spark, d).select("item", "line", "price")
    publish(first, store, "master", "v1")
    current = store.read("master", first.schema)
    rows = feed(spark, d).select("item", "line", "price")
    publish(upsert(current, rows, KEYS, ["price"], [*KEYS, "price"]), store, "master", "v2")
    return store.read("master", first.schema)


_PARTS = 64
_LAST_DAY = f"SELECT item, line, price FROM ({_FEED}) WHERE shipped = (SELECT max(l_shipdate) FROM lineitem)"


@query(
    "publish_touched",
    f"SELECT coalesce(m.item, f.item) AS item, coalesce(m.line, f.line) AS line, "
    "CASE WHEN f.item IS NULL THEN m.price ELSE f.price END AS price, "
    f"(SELECT count(DISTINCT {crc32_sql('CAST(item AS VARCHAR)')} % {_PARTS}) FROM ({_LAST_DAY})) "
    f"AS parts_written FROM ({_MASTER}) m FULL JOIN "
    f"(SELECT item, line, max(price) AS price FROM ({_LAST_DAY}) GROUP BY 1, 2) f "
    "ON m.item = f.item AND m.line = f.line",
)
def publish_last_day(spark, d):
    """The feed of the newest day merged into a master in parts: only the parts of its items are written."""
    store = Store(spark, f"{session.shared_folder(spark)}/goldweave-checks/{uuid.uuid4().hex}")
    layout = Layout(("item",), _PARTS)
    first = master(spark, d).select("item", "line", "price")
    store.commit([store.write_parts(first, "master", "v1", layout)], "v1")
    rows = feed(spark, d)
    newest = rows.agg(F.max("shipped").alias("shipped"))
    rows = rows.join(newest, "shipped", "left_semi").select("item", "line", "price")
    done = publish_touched(
        store, "master", first.schema, "v2", layout, rows,
        lambda old: upsert(old, rows, KEYS, ["price"], [*KEYS, "price"]))
    return done.rows.withColumn("parts_written", F.lit(len(done.rewritten)).cast("long"))
