"""The item load: change messages and a feed into the item master.

Order of application: change messages of the due windows, the feed, flags onto
every revision of an item, soft deletes. All four are folded over one join of
the master, so the wide rows are shuffled once, or not at all when the sources
are small or the master is bucketed by its key.

The job does a large load in a few goes, each for some of the items: what is
shuffled for one is off the disk before the next begins.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave import schema as S
from goldweave import session
from goldweave.operators.collapse import MergeSource, has_all
from goldweave.operators.counts import merge_counts
from goldweave.operators.latest import catch_up, window_maxima
from goldweave.operators.load import DUPLICATE_KEY, DUPLICATE_MESSAGE, insert_new
from goldweave.operators.normalize import (
    message_insert_defaults,
    normalize_feed,
    project_messages,
    stamps,
)
from goldweave.operators.quarantine import Rule, as_rejects, not_null, offset_date, split_rejects
from goldweave.operators.sizing import Size, fits_in_memory, row_width
from goldweave.operators.update import expand_to_keys
from goldweave.operators.upsert import merge
from goldweave.operators.windows import Windows, advance, due_windows
from goldweave.plans.audit import Audit
from goldweave.plans.control import close_sync
from goldweave.sources.lookup import job_frequency, lookup_one, property_is_on
from goldweave.sources.snapshot import AlreadyCommitted, Layout, Store, append_rejects
from goldweave.sources.tables import deleted_rows, flag_rows, of_source, read_changes, read_table

MESSAGES, FEED, FLAGS, DELETES = "messages", "feed", "flags", "deleted"
DUPLICATES = "duplicates"
MASTER_TABLE, CONTROL_TABLE, LATE_TABLE = "mst_item", "aif_last_sync_up", "late_messages"
# Name of the property that lets a load soft-delete.
DELETE_PROPERTY = "can_update_ent_state"
MODES = ("A", "B", "C")
# A load has one more go for so many bytes of feed files, up to a bound, as every go reads the master.
# The column of a staged feed that tells the go of a row.
GO_BYTES, MOST_GOES, GO = 16 * 1024 * 1024, 4, "_go"

KEY_RULES = (not_null(1400, "item_id"), not_null(1400, "revision"))
DATE_RULES = tuple(offset_date(1830, c) for c in S.OFFSET_DATES)


@dataclass(frozen=True)
class LoadInputs:
    """What a load reads. ``feed`` holds all sources; ``messages`` come from :func:`caught_up`."""

    master: DataFrame
    feed: DataFrame
    source: str
    run_ts: Column
    run_user: str
    mode: str = "A"
    messages: DataFrame | None = None
    delete: bool = True
    feed_rules: Sequence[Rule] = KEY_RULES
    message_rules: Sequence[Rule] = ()
    flag_rules: Sequence[Rule] = ()
    bad_dates: str = "abort"
    distinct: bool = True
    # Broadcast the sources instead of shuffling the master, if they fit. ``measured`` says that
    # they are known to; else they are measured first.
    small: bool = False
    measured: bool = False
    # Write small tables on the way: what an insert-only load finds new, digests of repeated rows.
    stage: bool = False


@dataclass(frozen=True)
class Goes:
    """In how many goes a load is done, and which rows belong to one.

    All that a row can reach has the same item (flags go by it), so goes are dealt by a hash of
    the item. With a master in parts it is that of the parts: a go then has whole parts.
    """

    n: int = 1
    layout: Layout | None = None

    def number(self) -> Column:
        return F.pmod((self.layout or Layout(("item_id",), self.n)).number(), F.lit(self.n))

    def of(self, rows: DataFrame, go: int) -> DataFrame:
        return rows if self.n == 1 else rows.where(self.number() == go)

    def parts(self, parts: Collection[int], go: int) -> set[int]:
        return {p for p in parts if p % self.n == go}


def goes_of(feed: DataFrame, layout: Layout | None) -> Goes:
    """Goes for a feed by the size of its files: their number decides nothing about the outcome."""
    size = int(str(feed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = min(MOST_GOES, layout.parts) if layout else MOST_GOES
    return Goes(max(1, min(most, -(-size // GO_BYTES))), layout)


@dataclass(frozen=True)
class StagedFeed:
    """The feed rows of a load, written once, and what was counted from the written rows.

    Numbers come from the table that was written, never from the pass that wrote it: a task
    that ran twice has written its rows once.
    """

    rows: DataFrame
    in_rows: int
    highest: int | None
    deleted: int
    size: Size

    def mine(self) -> DataFrame:
        return self.rows.where("_mine").drop("_mine", "_width", GO)

    def of(self, go: int | None) -> DataFrame:
        """The rows of one go, from a folder of their own, or all rows."""
        rows = self.rows if go is None or GO not in self.rows.columns else self.rows.where(F.col(GO) == go)
        return rows.drop("_mine", "_width", GO)


def stage_feed(feed: DataFrame, source: str, delete: bool = True, goes: Goes = Goes()) -> StagedFeed:
    """One pass over the feed: rows of the source, and those of any source in the deleted state.

    ``size`` is what a merge of them would broadcast. Without ``delete`` no other source's rows
    are kept. The rows of each go are in a folder of their own.
    """
    gone = F.coalesce(F.col("sys_ent_state") == S.DELETED, F.lit(False))
    mine = F.coalesce(F.col("sys_source") == source, F.lit(False))
    kept = (mine | gone) if delete else mine
    rows = feed.where(kept).withColumns({"_mine": mine, "_width": row_width(feed.schema)})
    rows = (session.staged(rows, "feed") if goes.n == 1
            else session.staged(rows.withColumn(GO, goes.number()), "feed", by=GO))
    gone = gone if delete else F.lit(False)
    keys = row_width(feed.select(*S.KEYS).schema)
    found = rows.agg(
        F.count_if("_mine").alias("n"),
        F.max(F.when(F.col("_mine"), F.col("transaction_seq"))).alias("highest"),
        F.count_if(gone).alias("deleted"),
        F.coalesce(F.sum(F.when(F.col("_mine"), F.col("_width"))), F.lit(0)).alias("width"),
        F.coalesce(F.sum(F.when(gone, keys)), F.lit(0)).alias("keys"),
    ).first()
    return StagedFeed(
        rows, found["n"], found["highest"], found["deleted"],
        Size(found["n"] + found["deleted"], found["width"] + found["keys"]))


@dataclass(frozen=True)
class LoadPlan:
    master: DataFrame
    rejects: dict[str, DataFrame]
    sources: list[str]
    flags: DataFrame


def caught_up(messages: DataFrame, windows: Windows) -> DataFrame:
    """Messages that win in one of the due windows, under their master names."""
    maxima = window_maxima(messages, windows)
    won = catch_up(messages, maxima)
    return project_messages(won, extra=["first_window", "last_window", "times"], distinct=False)


def arrived_late(log: DataFrame, control: DataFrame) -> DataFrame | None:
    """Messages of windows that have run which reached the log after the last completed sync.

    No later run looks at their windows again. ``log`` has the time of arrival as ``arrived``,
    ``control`` is the control row before it is advanced: its start is the end of the last window
    that ran. None if no sync has completed, since then nothing has run.
    """
    row = control.select("operation_status", "start_time", "sync_up_date").first()
    if row is None or row["operation_status"] != "SUCCESS" or row["start_time"] is None:
        return None
    before, since = (control.select(F.unix_micros(c)).first()[0] for c in ("start_time", "sync_up_date"))
    return log.where(
        (F.col("sys_creation_date") <= F.timestamp_micros(F.lit(before)))
        & (F.col("arrived") > F.timestamp_micros(F.lit(since))))


def _message_source(rows: DataFrame, i: LoadInputs) -> MergeSource:
    rows = rows.withColumns({"revision": F.lit(S.NO_REVISION), "name": F.col("description")})
    return MergeSource(
        MESSAGES,
        rows,
        update=S.MESSAGE_UPDATE,
        insert=S.MESSAGE_INSERT,
        constants=message_insert_defaults(i.run_ts, i.run_user),
        first_by=["first_window"],
        last_by=["last_window"],
        weight="times",
    )


def _feed_source(rows: DataFrame, i: LoadInputs) -> MergeSource:
    update, insert = {
        "A": (S.FEED_A_UPDATE, S.FEED_A_INSERT),
        "B": (S.FEED_B_UPDATE, S.FEED_B_INSERT),
        "C": ([], S.FEED_C_INSERT),
    }[i.mode]
    return MergeSource(FEED, rows, update=update, insert=insert, constants=stamps(i.run_ts))


def plan_load(i: LoadInputs) -> LoadPlan:
    """The new master and the rejects of a load, as lazy DataFrames."""
    if i.mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {i.mode!r}")
    mine = of_source(i.feed, i.source)
    rules = [*i.feed_rules, *(DATE_RULES if i.bad_dates == "reject" else ())]
    accepted, broken = split_rejects(mine, rules)
    rows = normalize_feed(
        accepted,
        bad_dates="null" if i.bad_dates == "reject" else "abort",
        distinct=i.distinct or i.mode == "C",
        stage=session.staged if i.stage else None,
    )
    rejects = {FEED: broken}
    flag_rows_, bad_flags = split_rejects(mine.select("item_id", "is_emc", "sys_ent_state"), i.flag_rules)
    rejects[FLAGS] = bad_flags
    sources, keyed = [], [i.master, accepted]
    if i.mode == "A" and i.messages is not None:
        kept, bad = split_rejects(i.messages, i.message_rules)
        rejects[MESSAGES] = bad.withColumns(
            {"revision": F.lit(S.NO_REVISION), "name": F.col("description")}
        )
        sources.append(_message_source(kept, i))
        keyed.append(sources[0].rows)
    sources.append(_feed_source(rows, i))
    if i.mode == "C":
        loaded = insert_new(
            i.master, rows, S.KEYS, S.FEED_C_INSERT, constants=stamps(i.run_ts),
            null_keys="absent", distinct=False, stage=session.staged if i.stage else None,
        )
        rejects[DUPLICATES] = loaded.duplicates.withColumns(
            {
                "sys_err_code": F.lit(DUPLICATE_KEY).cast("long"),
                "sys_err_mesg": F.lit(DUPLICATE_MESSAGE),
            }
        )
    flags = MergeSource(
        FLAGS,
        flag_rows_.select("item_id", "is_emc"),
        update=["is_emc", "sys_source", S.MODIFIED],
        constants={"sys_source": F.lit(i.source), S.MODIFIED: i.run_ts},
    )
    removed = MergeSource(
        DELETES,
        deleted_rows(i.feed).select(*S.KEYS),
        update=["sys_ent_state", S.MODIFIED],
        constants={"sys_ent_state": F.lit(S.DELETED), S.MODIFIED: i.run_ts},
    )
    names = [s.name for s in sources] + [FLAGS] + ([DELETES] if i.delete else [])
    last = [removed] if i.delete else []
    small = i.small and (i.measured or fits_in_memory(
        mine, *[s.rows for s in last], *[s.rows for s in sources if s.name == MESSAGES]))
    options = {"null_keys": "absent", "tally": True, "small_sources": small}
    if small:
        master = merge(i.master, sources + last, S.KEYS, **options)
        master = merge(master, [flags], ["item_id"], **options)
    else:
        by_key = expand_to_keys(flags.rows, ["item_id"], ["is_emc"], *keyed, keys=S.KEYS)
        whole = has_all(S.KEYS)
        every = [*sources, replace(flags, rows=by_key), *last]
        master = merge(i.master.where(whole), every, S.KEYS, **options)
        # Flags go by the item alone, so rows without a revision get them as well.
        partial = merge(
            i.master.where(~whole), [flags], ["item_id"], unique_target=False, **options)
        master = master.unionByName(partial, allowMissingColumns=True)
    return LoadPlan(master, rejects, names, flags.rows)


# --- the job --------------------------------------------------------------------


@dataclass(frozen=True)
class Paths:
    """Inputs as Parquet folders; ``store`` keeps the master, the rejects and the control rows."""

    feed: str
    changes: str
    jobs: str
    properties: str
    store: str
    audit: str


@dataclass(frozen=True)
class RunResult:
    code: int
    message: str
    counts: dict[str, int] = field(default_factory=dict)
    version: int | None = None
    # What went wrong once the load was published: it stands, and must not be run again.
    warnings: tuple[str, ...] = ()


class LoadFailed(RuntimeError):
    """A load that stopped before it was published. Nothing of it is visible but its audit rows."""

    def __init__(self, step: str, cause: BaseException):
        super().__init__(f"item load at {step}: {cause}")
        self.code = 1
        self.step = step


def instant(moment: datetime) -> Column:
    """Literal of a moment; a naive one is meant as UTC."""
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    whole = int(moment.replace(microsecond=0).timestamp())
    return F.timestamp_micros(F.lit(whole * 1_000_000 + moment.microsecond))


def run_item_load(
    spark: SparkSession,
    paths: Paths,
    source: str,
    sync_id: str,
    *,
    run_ts: datetime,
    run_user: str,
    mode: str = "A",
    job_instance_id: str | None = None,
    run_id: str | None = None,
    feed_rules: Sequence[Rule] = KEY_RULES,
    message_rules: Sequence[Rule] = (),
    flag_rules: Sequence[Rule] = (),
    bad_dates: str = "abort",
    distinct: bool = True,
    buckets: int | None = None,
    parts: int | None = None,
) -> RunResult:
    """Run one load and publish its outcome, all of it or nothing.

    ``feed_rules`` and ``message_rules`` say which rows are rejected; feed rows
    without a key always are. ``bad_dates='reject'`` turns dates that do not
    parse into rejects. ``buckets`` lays the master out by its key, which saves
    every later load the shuffle of the master. ``parts`` lays it out by its item
    instead: a load then reads and writes only the parts that hold an item of its
    sources, and leaves the files of all others as they are.

    A run id that has been committed is refused before anything is written. The
    merge is audited as done once it is committed, and a failure before always leaves an
    audit row. Messages that came too late for their windows are not merged; they go to the
    table of late messages of the store. An audit row that cannot be written after the commit does not undo it:
    the load is a success, with a warning.
    """
    if not source:
        raise ValueError("a load needs a source")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if buckets and parts:
        raise ValueError("a master is laid out in buckets or in parts, not both")
    run_id = run_id or f"{sync_id}-{source}-{mode}-{run_ts:%Y%m%dT%H%M%S%f}"
    with session.load_settings(spark), session.passing_tables(spark):
        return _run(
            spark, paths, source, sync_id, run_ts, run_user, mode, job_instance_id, run_id,
            dict(feed_rules=feed_rules, message_rules=message_rules, flag_rules=flag_rules,
                 bad_dates=bad_dates, distinct=distinct), buckets, parts)


def reject_constants(step: str, source: str, run_user: str) -> dict[str, Column]:
    """What a step writes into its rejects instead of what the row has."""
    if step == MESSAGES:
        by = {c: F.lit(run_user) for c in ("sys_created_by", "sys_last_modified_by")}
        return {"sys_ent_state": F.lit(S.ACTIVE), "item_type": F.lit(S.MESSAGE_ITEM_TYPE), **by}
    if step == DUPLICATES:
        return {"sys_ent_state": F.lit(S.ACTIVE), "sys_source": F.lit(source)}
    return {"sys_source": F.lit(source)}


def _run(spark, paths, source, sync_id, run_ts, run_user, mode, job_instance_id, run_id, options,
         buckets, parts) -> RunResult:
    audit = Audit(spark, paths.audit, run_id, job_instance_id, sync_id)
    now, store = instant(run_ts), Store(spark, paths.store)
    if store.is_committed(run_id):
        raise AlreadyCommitted(f"run {run_id} has been committed before")
    at, step, in_rows, merged = "lookups", None, 0, 0
    try:
        control = store.read(CONTROL_TABLE, S.CONTROL_SCHEMA)
        frequency = job_frequency(read_table(spark, paths.jobs, S.JOB_SCHEMA), sync_id)
        delete = property_is_on(
            read_table(spark, paths.properties, S.PROPERTY_SCHEMA), DELETE_PROPERTY
        )
        at = "feed"
        layout = Layout(("item_id",), parts) if parts else None
        arrived = read_table(spark, paths.feed, S.FEED_SCHEMA)
        goes = goes_of(arrived, layout)
        feed = stage_feed(arrived, source, delete, goes)
        in_rows = feed.in_rows

        at = "audit"
        step = audit.start("MERGE", f"Merge the item feed into the item master for {source}", in_rows)

        messages = late = None
        if mode == "A":
            at = "windows"
            lookup_one(control, F.col("sync_up_id") == sync_id, ["sync_up_id"], f"control row {sync_id}")
            planned = due_windows(
                control.where(F.col("sync_up_id") == sync_id), F.lit(frequency), now
            )
            windows = Windows.of(planned)
            late = arrived_late(
                read_changes(spark, paths.changes, arrived="arrived"),
                control.where(F.col("sync_up_id") == sync_id))
            control = advance(control, planned, sync_id)
            if windows.n:
                at = "messages"
                # used by the size check, the merge and the rejects; the log is the largest input
                log = read_changes(spark, paths.changes)
                messages = session.staged(caught_up(log, windows), "messages")

        at = "merge"
        options["feed_rules"] = [
            *KEY_RULES, *[r for r in options["feed_rules"] if not any(r is k for k in KEY_RULES)]]
        sides = [feed.size, *([] if messages is None else [messages])]
        small = fits_in_memory(*sides)
        goes = Goes() if small else goes
        touched = None
        if layout and store.layout(MASTER_TABLE) == layout:
            # Flags go by the item, so an item's part is all that any row can reach.
            items = feed.rows.select("item_id")
            touched = layout.of(items if messages is None else items.union(messages.select("item_id")))
        plans: list[LoadPlan] = []

        def planned_masters() -> Iterator[DataFrame]:
            for go in range(goes.n):
                before = (goes.of(store.read(MASTER_TABLE, S.MASTER_SCHEMA), go) if touched is None
                          else store.read_parts(MASTER_TABLE, S.MASTER_SCHEMA, goes.parts(touched, go)))
                plans.append(plan_load(
                    LoadInputs(
                        master=before,
                        feed=feed.of(None if goes.n == 1 else go),
                        source=source,
                        run_ts=now,
                        run_user=run_user,
                        mode=mode,
                        messages=None if messages is None else goes.of(messages, go),
                        delete=delete,
                        small=small,
                        measured=True,
                        stage=True,
                        **options,
                    )
                ))
                if not small:
                    session.free_shuffles(spark)
                yield plans[-1].master

        if layout:
            master = store.write_parts(planned_masters(), MASTER_TABLE, run_id, layout, touched)
        else:
            master = store.write(
                planned_masters(), MASTER_TABLE, run_id,
                buckets=buckets, bucket_columns=S.KEYS if buckets else None,
            )
        at = "rejects"
        errors = append_rejects(
            (_union([as_rejects(r, name, run_id, now, reject_constants(name, source, run_user))
                     for name, r in plan.rejects.items()]) for plan in plans),
            store, run_id)
        if not small:
            session.free_shuffles(spark)
        also = []
        if late is not None:
            at = "late messages"
            also = [store.write(late.drop("arrived"), LATE_TABLE, run_id)]

        at = "counts"
        written = spark.read.schema(plans[0].master.schema).parquet(master.path)
        counts = merge_counts(written, plans[0].sources).first().asDict()
        counts["in_rows"] = in_rows
        flags = _union([plan.flags for plan in plans])
        counts[f"{FLAGS}_merged"] = flag_rows(flags, flags=["is_emc"]).count()
        counts["rejected"] = spark.read.parquet(errors.path).count()
        if also:
            counts["late"] = spark.read.schema(S.MESSAGE_SCHEMA).parquet(also[0].path).count()
        if layout:
            counts["parts_written"] = len(master.rewritten)
        merged = counts[f"{FEED}_inserted"] if mode == "C" else counts[f"{FEED}_merged"]
        inserted = sum(v for k, v in counts.items() if k.endswith("_inserted"))
        updated = counts[f"{FLAGS}_updated"] + counts.get(f"{DELETES}_updated", 0)
        done = {
            "rows_in": in_rows, "rows_merged": merged, "rows_inserted": inserted,
            "rows_updated": 0, "rows_rejected": counts["rejected"],
        }
        at = "control"
        highest = spark.range(1).select(F.lit(feed.highest).cast("long").alias("transaction_seq"))
        closed = close_sync(control, highest, sync_id, now, job_instance_id)
        state = store.write(closed.coalesce(1), CONTROL_TABLE, run_id)
        at = "publish"
        version = store.commit([master, errors, state, *also], run_id)
    except Exception as e:
        if step is None:
            step = audit.start("MERGE", f"Merge the item feed into the item master for {source}", in_rows)
        audit.end(step, f"ERROR{e}", rows_in=in_rows, rows_merged=merged, rows_rejected=1)
        raise LoadFailed(at, e) from e
    # The load is published: whatever fails from here on cannot make it a failure.
    warnings = []
    try:
        audit.end(step, "INSERT SUCCEEDED" if mode == "C" else "MERGE SUCCEEDED", **done)
        audit.end(step, "UPDATE SUCCEEDED", **{**done, "rows_updated": updated})
        step = audit.start("UPDATE_SYNCUP", "Close the control row")
        audit.end(
            step, f"UPDATE SUCCEEDED{run_ts:%Y-%m-%d %H:%M:%S}:{sync_id}",
            rows_in=in_rows, rows_merged=merged,
        )
    except Exception as e:
        warnings.append(f"published as version {version}, but its audit is incomplete: {e}")
    return RunResult(0, "SUCCESS", counts, version, tuple(warnings))


OUTCOME = "code int, message string, location string, published boolean, warnings int, rows_in long, rows_merged long"


def load_outcome(spark: SparkSession, paths: Paths, source: str, sync_id: str, **options) -> DataFrame:
    """Run a load and return how it ended, as one row, whatever happened.

    ``code`` is 0 and ``message`` SUCCESS after a load that was published, also one with
    ``warnings``; otherwise ``code`` is 1, ``message`` says why and ``location`` at which step.
    Arguments are those of :func:`run_item_load`; ones it refuses are a failure at ``call``.
    """
    try:
        r = run_item_load(spark, paths, source, sync_id, **options)
        merged = r.counts[f"{FEED}_inserted" if options.get("mode") == "C" else f"{FEED}_merged"]
        row = (r.code, r.message, "done", True, len(r.warnings), r.counts["in_rows"], merged)
    except LoadFailed as e:
        row = (e.code, str(e.__cause__), e.step, False, 0, None, None)
    except ValueError as e:
        row = (1, str(e), "call", False, 0, None, None)
    return spark.createDataFrame([row], OUTCOME)


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for p in rest:
        first = first.unionByName(p)
    return first
