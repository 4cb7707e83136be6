"""Incremental windows, in batch and as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from goldweave import session
from goldweave.checks.registry import query, ranked, schema_of, table
from goldweave.operators import (
    MergeSource,
    Windows,
    catch_up,
    collapse_many,
    due_windows,
    late_messages,
    latest_in_window,
    window_maxima,
)
from goldweave.operators.windows import advance
from goldweave.streaming.catchup import numbered, stream_maxima

NAMES = {"item": "user_id", "seq": "seq", "at": "ts"}
_MESSAGES = "SELECT *, CAST(hour(ts) AS BIGINT) AS seq FROM events"
# the due windows, numbered: six hours each, ended twelve hours before the newest event
DUE = (
    "SELECT * FROM (SELECT n AS win, TIMESTAMP '2024-01-01' + INTERVAL 6 HOUR * n AS s, "
    "TIMESTAMP '2024-01-01' + INTERVAL 6 HOUR * (n + 1) AS e FROM range(CAST((SELECT epoch(max(ts)) - epoch(TIMESTAMP '2024-01-01') FROM events) / 21600 AS BIGINT) + 1) r(n)) "
    "WHERE e + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events)"
)
_MAXIMA = (
    f"SELECT w.win, e.user_id, max(e.seq) AS seq FROM ({DUE}) w JOIN ({_MESSAGES}) e "
    "ON e.ts BETWEEN w.s AND w.e GROUP BY 1, 2"
)


def windows(spark, d) -> Windows:
    """Windows due if the last sync was at the newest event and the first starts with 2024."""
    control = table(spark, d, "events").agg(F.max("ts").alias("sync_up_date")).select(
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("start_time"),
        F.lit("2024-01-01 06:00:00").cast("timestamp").alias("end_time"),
        "sync_up_date",
    )
    return Windows.of(due_windows(control, F.lit(4), F.current_timestamp()))


def messages(spark, d):
    """Events as messages; the hour as number makes ties with other days."""
    return table(spark, d, "events").withColumn("seq", F.hour("ts").cast("long"))


@query(
    "latest_in_window",
    f"WITH x AS ({_MESSAGES}) SELECT event_id, user_id, seq, event_type, ts FROM x x1 WHERE seq = "
    "(SELECT max(x2.seq) FROM x x2 WHERE x2.user_id = x1.user_id AND x2.ts BETWEEN "
    "TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-05 12:00:00')",
)
def latest(spark, d):
    rows = messages(spark, d).select("event_id", "user_id", "seq", "event_type", "ts")
    start, end = (F.lit(f"2024-01-05 {h}:00:00").cast("timestamp") for h in ("00", "12"))
    return latest_in_window(rows, start, end, **NAMES)


@query("window_maxima", f"SELECT win AS window_no, user_id, seq FROM ({_MAXIMA})")
def maxima(spark, d):
    return window_maxima(messages(spark, d), windows(spark, d), **NAMES).withColumnRenamed("window", "window_no")


@query(
    "late_messages",
    f"SELECT e.event_id, e.user_id, w.win AS window_no, w.e AS window_end FROM ({DUE}) w JOIN events e "
    "ON e.ts BETWEEN w.s AND w.e WHERE e.ts + INTERVAL 1 HOUR * CAST(floor(e.value) AS BIGINT) > "
    "w.e + INTERVAL 12 HOUR",
)
def late(spark, d):
    """Events that arrive as many hours late as their value says."""
    arrived = F.timestamp_micros(F.unix_micros("ts") + F.floor("value").cast("long") * 3_600_000_000)
    return late_messages(table(spark, d, "events"), windows(spark, d), arrived, at="ts").select(
        "event_id", "user_id", F.col("window").alias("window_no"), "window_end")


_APPLIED = (
    f"SELECT w.win, x.user_id, x.event_type, x.value FROM ({_MAXIMA}) w JOIN ({_MESSAGES}) x "
    "ON x.user_id = w.user_id AND x.seq = w.seq"
)


@query(
    "catchup_windows",
    f"WITH p AS ({_APPLIED}), a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "
    f"{ranked(['win', 'event_type', 'value'])}) AS n FROM p), z AS (SELECT *, row_number() OVER "
    f"(PARTITION BY user_id ORDER BY {ranked(['win', 'event_type', 'value'], last=True)}) AS n FROM p), "
    "c AS (SELECT user_id, count(*) AS applied FROM p GROUP BY 1) "
    "SELECT c.user_id, a.win AS first_win, a.event_type AS first_type, a.value AS first_value, "
    "z.win AS last_win, z.event_type AS last_type, z.value AS last_value, c.applied "
    "FROM c JOIN a USING (user_id) JOIN z USING (user_id) WHERE a.n = 1 AND z.n = 1",
)
def catchup(spark, d):
    """All windows in one pass: the first and the last message applied to each user."""
    log = messages(spark, d)
    won = catch_up(log, window_maxima(log, windows(spark, d), **NAMES), item="user_id", seq="seq")
    applied = MergeSource(
        "m", won, update=["event_type", "value"],
        insert=["user_id", "first_window", "event_type", "value"],
        first_by=["first_window"], last_by=["last_window"], weight="times")
    one = collapse_many([applied], ["user_id"])
    first, last = F.col(applied.first), F.col(applied.last)
    return one.select(
        "user_id", first["first_window"].alias("first_win"), first["event_type"].alias("first_type"),
        first["value"].alias("first_value"), last["last_window"].alias("last_win"),
        last["event_type"].alias("last_type"), last["value"].alias("last_value"),
        F.col(applied.count).alias("applied"))


_CONTROL = (
    "SELECT user_id AS sync_up_id, CASE WHEN min(event_type) = 'click' AND count(*) > 60 THEN NULL "
    "ELSE min(ts) END AS start_time, CASE WHEN count(*) > 70 THEN NULL ELSE "
    "min(ts) + INTERVAL 5 HOUR END AS end_time, max(ts) AS sync_up_date FROM events GROUP BY user_id"
)
_NOW = "TIMESTAMP '2024-01-10 11:30:00'"
_PLAN = (
    f"WITH c AS ({_CONTROL}), h AS (SELECT *, "
    f"date_trunc('hour', {_NOW} + INTERVAL 30 MINUTE) AS hr FROM c), "
    "b AS (SELECT sync_up_id, start_time, end_time, sync_up_date, "
    "coalesce(start_time, hr - INTERVAL 17280 SECOND) AS ws, coalesce(end_time, hr) AS we FROM h), "
    "n AS (SELECT *, CAST(greatest(0, 1 + floor(CAST(epoch_us(date_trunc('second', sync_up_date)) - "
    "epoch_us(date_trunc('second', we)) - 34560000000 AS DOUBLE) / 17280000000)) AS BIGINT) AS due FROM b) "
)


@query(
    "window_advance",
    _PLAN + "SELECT sync_up_id, ws AS window_start, we AS window_end, due, "
    "CASE WHEN due = 0 THEN start_time WHEN due = 1 THEN we ELSE date_trunc('second', we) + "
    "INTERVAL 17280 SECOND * (due - 1) END AS next_start, "
    "CASE WHEN due = 0 THEN end_time ELSE date_trunc('second', we) + INTERVAL 17280 SECOND * due END "
    "AS next_end FROM n",
)
def window_advance(spark, d):
    """Window plans of many control rows at once, at five runs a day."""
    return _planned(spark, d).select(
        "sync_up_id", "window_start", "window_end", "due", "next_start", "next_end"
    )


def _control(spark, d):
    n, first = F.count(F.lit(1)), F.min("ts")
    return table(spark, d, "events").groupBy(F.col("user_id").alias("sync_up_id")).agg(
        F.when(~((F.min("event_type") == "click") & (n > 60)), first).alias("start_time"),
        F.when(n <= 70, first + F.expr("INTERVAL 5 HOURS")).alias("end_time"),
        F.max("ts").alias("sync_up_date"),
    )


def _planned(spark, d):
    now = F.lit("2024-01-10 11:30:00").cast("timestamp")
    return due_windows(_control(spark, d), F.lit(5), now)


@query(
    "control_advance",
    _PLAN + "SELECT sync_up_id, CASE WHEN sync_up_id <> 3 OR due = 0 THEN start_time WHEN due = 1 THEN "
    "we ELSE date_trunc('second', we) + INTERVAL 17280 SECOND * (due - 1) END AS start_time, "
    "CASE WHEN sync_up_id <> 3 OR due = 0 THEN end_time ELSE date_trunc('second', we) + "
    "INTERVAL 17280 SECOND * due END AS end_time, sync_up_date FROM n",
)
def control_advance(spark, d):
    return advance(_control(spark, d), _planned(spark, d), 3)


@query(
    "stream_catchup",
    f"SELECT win AS window_no, user_id, seq FROM ({_MAXIMA})",
)
def stream_catchup(spark, d):
    """The same maxima from a file stream, run until all files are read."""
    folder = f"{session.shared_folder(spark)}/goldweave-checks/{uuid.uuid4().hex}"
    stream = (
        spark.readStream.schema(schema_of("events"))
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
        .withColumn("seq", F.hour("ts").cast("long"))
    )
    first = windows(spark, d)
    finished = numbered(stream_maxima(stream, first, **NAMES), first)
    query = (
        finished.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/maxima")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = "user_id long, seq long, window long"
    return spark.read.schema(schema).parquet(f"{folder}/maxima").withColumnRenamed(
        "window", "window_no"
    )
