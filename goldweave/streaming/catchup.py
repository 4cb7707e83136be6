"""The incremental windows as a stream.

A file stream of change messages is aggregated to the highest number per
(window, item); a window comes out once the newest message is two strides past
its end, which is the rule by which the batch job finds a window due, with the
newest message in place of the last sync. Each micro-batch of finished windows
is joined to the message log and merged into the master.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldweave import schema as S
from goldweave.operators.collapse import MergeSource
from goldweave.operators.latest import catch_up
from goldweave.operators.normalize import message_insert_defaults, project_messages
from goldweave.operators.sizing import fits_in_memory
from goldweave.operators.upsert import merge
from goldweave.operators.windows import Windows, micros
from goldweave.session import staged
from goldweave.sources.snapshot import Layout, Store, Written, short_name

_MICRO = 1


def stream_maxima(
    messages: DataFrame,
    first: Windows,
    *,
    item: str = "item",
    seq: str = "seq_num",
    at: str = "sys_creation_date",
) -> DataFrame:
    """Highest number per (window end, item) of finished windows, in append mode.

    Windows are half-open in Spark and closed here, so a message is counted at
    its own time and again one microsecond earlier: the second copy puts one on
    a boundary into the window that ends there. ``first`` gives the stored
    window and the stride; messages before it are left out. The stored window
    may be longer than a stride: its messages are moved up into its last stride.
    """
    stride = first.stride
    lowest = F.lit(first.anchor - stride)
    us = micros(at)
    rows = (
        messages.select(item, seq, us.alias("_us"))
        .where(F.col("_us") >= first.start)
        .withColumn("_us", F.explode(F.array(F.col("_us"), F.col("_us") - _MICRO)))
        .withColumn("_at", F.timestamp_micros(F.greatest(F.col("_us"), lowest)))
        .withWatermark("_at", f"{2 * first.stride_s} seconds")
    )
    offset = first.anchor % stride // 1_000_000
    window = F.window("_at", f"{first.stride_s} seconds", startTime=f"{offset} seconds")
    return (
        rows.groupBy(window.alias("w"), item)
        .agg(F.max(seq).alias(seq))
        .select(F.col("w.end").alias("window_end"), item, seq)
    )


def numbered(maxima: DataFrame, first: Windows) -> DataFrame:
    """Window numbers counted from the stored window, as the batch job counts them."""
    number = ((micros("window_end") - first.anchor) / first.stride).cast("long")
    return maxima.withColumn("window", number).drop("window_end")


def start_catch_up(
    messages: DataFrame,
    first: Windows,
    store: Store,
    read_log: Callable[[], DataFrame],
    *,
    name: str,
    checkpoint: str,
    run_ts: Column | Callable[[], Column],
    run_user: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge finished windows into the master, micro-batch by micro-batch.

    ``read_log`` gives the message log as a batch table. The end of the last
    window is committed with the master it led to. Windows finish in order, so
    what comes again, after a failure or from a new checkpoint, is known by it,
    and only what was not merged yet is. ``run_ts`` is the stamp of all batches,
    or a function that is asked once per batch.
    """
    if first.end % 1_000_000:
        raise ValueError("the stored window must end on a whole second")

    def apply(batch: DataFrame, batch_id: int) -> None:
        # written at once, as the state store has to see every batch run through
        rows = staged(batch, f"stream-{name}")
        last = store.last_window(name)
        if last is not None:
            rows = rows.where(micros("window_end") > last)
        newest = rows.agg(F.max(micros("window_end"))).first()[0]
        if newest is not None:
            merge_batch(rows, newest)

    def merge_batch(finished: DataFrame, newest: int) -> None:
        stamp = run_ts() if callable(run_ts) else run_ts
        # the items of the batch are few beside the log: only their messages are looked at
        items = finished.select("item").distinct()
        if fits_in_memory(items):
            items = F.broadcast(items)
        log = read_log().join(items, "item", "left_semi")
        won = catch_up(log, numbered(finished, first))
        rows = project_messages(won, extra=["first_window", "last_window", "times"], distinct=False)
        _merge_won(store, rows, name, newest, f"{name}-{newest}", stamp, run_user)

    writer = (
        stream_maxima(messages, first)
        .writeStream.outputMode("append")
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _merge_won(
    store: Store, rows: DataFrame, name: str, newest: int, run_id: str, stamp: Column, run_user: str,
    layout: Layout | None = None, also: Sequence[Written] = (),
) -> None:
    """Merge winners, under their master names, and commit with them the end of the last window."""
    source = MergeSource(
        "messages",
        staged(rows.withColumns({"revision": F.lit(S.NO_REVISION), "name": F.col("description")}), f"won-{name}"),
        update=S.MESSAGE_UPDATE,
        insert=S.MESSAGE_INSERT,
        constants=message_insert_defaults(stamp, run_user),
        first_by=["first_window"],
        last_by=["last_window"],
        weight="times",
    )
    touched = layout.of(source.rows) if layout and store.layout("mst_item") == layout else None
    master = (store.read("mst_item", S.MASTER_SCHEMA) if touched is None
              else store.read_parts("mst_item", S.MASTER_SCHEMA, touched))
    merged = merge(master, [source], S.KEYS, null_keys="absent", small_sources=fits_in_memory(source.rows))
    written = (store.write(merged, "mst_item", run_id) if layout is None else store.write_parts(
        merged, "mst_item", run_id, layout, touched))
    store.commit([written, *also], run_id, stream=name, window_end=newest)


LATE_TABLE = "late_messages"
# A late message with the end of the window it came too late for.
LATE_SCHEMA = T.StructType([*S.MESSAGE_SCHEMA.fields, T.StructField("window_end", T.TimestampType())])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The state is kept on disk, and a batch commits what it changed, not whole snapshots of it.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def winners(messages: DataFrame, first: Windows, *, item: str = "item", seq: str = "seq_num",
            at: str = "sys_creation_date") -> DataFrame:
    """The messages that win in a finished window, with its end, found in the stream's own state.

    The highest numbers of finished windows are joined to the messages by (item, number), stream
    to stream. The state of that join is keyed by both, so a hot item is spread over its numbers.
    It keeps every message, as any may win whatever its time, and every highest number.
    """
    maxima = stream_maxima(messages, first, item=item, seq=seq, at=at)
    return messages.join(maxima, [item, seq], "inner").select(*messages.columns, "window_end")


def start_state_catch_up(
    messages: DataFrame,
    first: Windows,
    store: Store,
    *,
    name: str,
    checkpoint: str,
    run_ts: Column | Callable[[], Column],
    run_user: str,
    layout: Layout | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """As :func:`start_catch_up`, without a message log: a batch costs what it holds, not the log.

    The stream has to start at the first message, and keeps messages on the executors' disks and
    in the checkpoint (RocksDB). With ``layout`` only the parts of the master that hold an item of
    the batch are read and written.

    A message that comes after a window it would have won in was merged is not applied any more.
    It goes to the table of late messages, with the end of that window.
    """
    if first.end % 1_000_000:
        raise ValueError("the stored window must end on a whole second")

    own = f"{name}-{short_name(checkpoint)}-"

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = staged(batch, f"stream-{name}")
        run_id = f"{own}{batch_id}"
        if store.is_committed(run_id):  # the same batch again, after a failure behind the commit
            return

        def over(last: int | None) -> Column:
            return F.lit(False) if last is None else micros("window_end") <= last

        # What another checkpoint merged comes again here, but it is not late.
        mine = store.commits().where(F.col("run_id").startswith(own)).agg(F.max("window_end")).first()[0]
        late = rows.where(over(mine)).select(*[f.name for f in LATE_SCHEMA.fields])
        also = [] if mine is None or late.isEmpty() else [store.write(late, LATE_TABLE, run_id)]
        fresh = rows.where(~over(store.last_window(name)))
        newest = fresh.agg(F.max(micros("window_end"))).first()[0]
        if newest is not None:
            won = numbered(fresh, first).groupBy(*messages.columns).agg(
                F.min("window").alias("first_window"), F.max("window").alias("last_window"),
                F.count(F.lit(1)).alias("times"))
            won = project_messages(won, extra=["first_window", "last_window", "times"], distinct=False)
            stamp = run_ts() if callable(run_ts) else run_ts
            _merge_won(store, won, name, newest, run_id, stamp, run_user, layout, also)
        elif also:
            store.commit(also, run_id)

    spark = messages.sparkSession
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        writer = (
            winners(messages, first)
            .writeStream.outputMode("append")
            .foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .queryName(name)
        )
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_message_stream(spark: SparkSession, path: str, schema=S.MESSAGE_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
