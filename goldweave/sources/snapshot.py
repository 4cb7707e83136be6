"""Versioned tables: write first, then make everything visible with one small append.

A run writes each table into a directory of its own. It becomes current when a
row per table is appended to the commit table, all in one file, so a reader sees
all of a run or nothing of it. Every attempt has a directory of its own, so what
a commit names is never written again; a run that dies leaves only directories
nobody reads. The commit table grows by one small file per run. One writer at a
time is assumed.

A table may be laid out in parts, by a hash of some of its columns. A run that
changes few keys then writes only the parts those keys are in; its commit names
the new folders of these and the old folders of all others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave import schema as S
from goldweave.session import COMPRESSED

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("window_end", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("bucket_columns", T.StringType()),
        # Of a table in parts: how many, by which columns, and the folder of each that has rows.
        T.StructField("parts", T.IntegerType()),
        T.StructField("part_columns", T.StringType()),
        T.StructField("part_paths", T.MapType(T.IntegerType(), T.StringType())),
    ]
)


# Folder of one attempt at writing a table, as a partition column of the table's root.
ATTEMPT = "attempt"


# Folder of one part, as a partition column of an attempt.
PART = "part"


class AlreadyCommitted(ValueError):
    """The run id has been used by a completed run."""


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _each(rows: DataFrame | Iterable[DataFrame]) -> Iterable[DataFrame]:
    return [rows] if isinstance(rows, DataFrame) else rows


def short_name(path: str) -> str:
    return hashlib.sha256(path.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Layout:
    """Rows with equal ``columns`` are in one of ``parts`` parts.

    A part is what a change to any of its rows rewrites: have so many that one is a few
    gigabytes. Their number bounds the map in a commit and what is collected to plan a write.
    """

    columns: tuple[str, ...]
    parts: int

    def number(self) -> Column:
        """The part of a row; the same in every version of every engine, as it stays on disk."""
        text = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in self.columns])
        return F.pmod(F.crc32(text), F.lit(self.parts)).cast("int")

    def of(self, rows: DataFrame) -> set[int]:
        """The parts that hold the keys of ``rows``: at most ``parts`` numbers."""
        return {r[0] for r in rows.select(self.number().alias(PART)).distinct().collect()}


@dataclass(frozen=True)
class Written:
    table: str
    path: str
    buckets: int | None = None
    bucket_columns: str | None = None
    layout: Layout | None = None
    # The folders of all parts after this write, and the parts that it wrote.
    part_paths: dict[int, str] | None = None
    rewritten: frozenset[int] = frozenset()


@dataclass(frozen=True)
class Store:
    """Tables under one root folder."""

    spark: SparkSession
    root: str

    @property
    def _commits(self) -> str:
        return f"{self.root}/commits"

    def commits(self) -> DataFrame:
        return read_or_empty(self.spark, self._commits, COMMIT_SCHEMA)

    def _current(self, table: str) -> Row | None:
        latest = self.commits().where(F.col("table") == table)
        row = latest.agg(F.max_by(F.struct("*"), "version").alias("c")).first()
        return row["c"]

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """Current state of a table; empty before its first commit."""
        c = self._current(table)
        if c is None:
            return self.spark.createDataFrame([], schema)
        if c["parts"]:
            return self._parts(c, schema)
        if c["buckets"]:
            return self._bucketed(c, schema)
        return self.spark.read.schema(schema).parquet(c["path"])

    def layout(self, table: str) -> Layout | None:
        """How a table is laid out in parts, if it is."""
        c = self._current(table)
        return Layout(tuple(c["part_columns"].split(",")), c["parts"]) if c and c["parts"] else None

    def read_parts(self, table: str, schema: T.StructType, parts: Collection[int]) -> DataFrame:
        """The rows of some parts of a table in parts; the files of others are not even listed."""
        c = self._current(table)
        if c is None or not c["parts"]:
            raise ValueError(f"{table} is not laid out in parts")
        return self._parts(c, schema, parts)

    def _parts(self, c: Row, schema: T.StructType, only: Collection[int] | None = None) -> DataFrame:
        paths = [p for n, p in sorted(c["part_paths"].items()) if only is None or n in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _bucketed(self, c: Row, schema: T.StructType) -> DataFrame:
        """Read a bucketed directory with its layout, so joins on the key skip the shuffle."""
        name = f"goldweave_read_{short_name(c['path'])}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({c['bucket_columns']}) INTO {c['buckets']} BUCKETS "
            f"LOCATION '{c['path']}'"
        )
        rows = self.spark.table(name)
        # the rows keep the layout; an external table's name can go, the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return rows

    def read_all(self, table: str, schema: T.StructType) -> DataFrame:
        """Every committed run's rows of a table that only grows (rejects)."""
        with_attempt = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
        every = read_or_empty(self.spark, f"{self.root}/{table}", with_attempt)
        done = self.commits().where(F.col("table") == table).select(
            F.substring_index("path", f"{ATTEMPT}=", -1).alias(ATTEMPT))
        return every.join(done, ATTEMPT, "left_semi").select(*[f.name for f in schema.fields])

    def is_committed(self, run_id: str) -> bool:
        return not self.commits().where(F.col("run_id") == run_id).isEmpty()

    def last_window(self, stream: str) -> int | None:
        """End, in microseconds, of the last window a stream has committed."""
        return self.commits().where(F.col("stream") == stream).agg(F.max("window_end")).first()[0]

    def write(
        self,
        rows: DataFrame | Iterable[DataFrame],
        table: str,
        run_id: str,
        *,
        buckets: int | None = None,
        bucket_columns: list[str] | None = None,
    ) -> Written:
        """Write a table's next state, not visible yet.

        ``rows`` may come in several frames of one shape, which are written one after the other.
        With ``buckets`` the files are laid out by hash of ``bucket_columns``;
        the next merge on those columns then reads the table without shuffling
        it. A bucket has as many files as tasks had rows of it: the wide rows are
        not shuffled once more for fewer, which would bring each bucket into one task.
        """
        if self.is_committed(run_id):
            raise AlreadyCommitted(f"run {run_id} has been committed before")
        path = f"{self.root}/{table}/{ATTEMPT}={uuid.uuid4().hex}"
        if not buckets:
            for some in _each(rows):
                some.write.mode("append").options(**COMPRESSED).parquet(path)
            return Written(table, path)
        name = f"goldweave_write_{short_name(path)}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for some in _each(rows):
            some.write.mode("append").bucketBy(buckets, *bucket_columns).options(path=path, **COMPRESSED).format(
                "parquet"
            ).saveAsTable(name)
        # an external table: only its name goes, the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return Written(table, path, buckets, ", ".join(bucket_columns))

    def write_parts(
        self,
        rows: DataFrame | Iterable[DataFrame],
        table: str,
        run_id: str,
        layout: Layout,
        touched: Collection[int] | None = None,
    ) -> Written:
        """Write the next state of some parts of a table, not visible yet; the others stay as they are.

        ``rows`` is all that the ``touched`` parts hold afterwards; a row that belongs elsewhere
        is an error, as its part would lose what it has. Without ``touched`` all parts are
        written, whatever the table was before. ``rows`` may come in several frames, as in :meth:`write`.

        The rows of a part are brought together for that, as a task that held some of every part
        would write a file for each. Spark splits a part that is too large for one task, and puts
        small ones together.
        """
        if self.is_committed(run_id):
            raise AlreadyCommitted(f"run {run_id} has been committed before")
        before: dict[int, str] = {}
        if touched is not None:
            if self.layout(table) != layout:
                raise ValueError(f"{table} is not laid out by {layout}")
            kept = self._current(table)["part_paths"]
            before = {n: p for n, p in kept.items() if n not in touched}
        path = f"{self.root}/{table}/{ATTEMPT}={uuid.uuid4().hex}"
        for some in _each(rows):
            dealt = some.withColumn(PART, layout.number()).hint("rebalance", PART)
            dealt.write.mode("append").options(**COMPRESSED).partitionBy(PART).parquet(path)
        found = self.spark.read.schema(f"{PART} int").parquet(path).select(PART).distinct().collect()
        new = {r[0]: f"{path}/{PART}={r[0]}" for r in found}
        strays = set() if touched is None else set(new) - set(touched)
        if strays:
            raise ValueError(f"{table}: rows of parts that were not named as touched: {sorted(strays)}")
        return Written(
            table, path, layout=layout, part_paths=before | new,
            rewritten=frozenset(new if touched is None else touched))

    def commit(
        self,
        written: list[Written],
        run_id: str,
        *,
        stream: str | None = None,
        window_end: int | None = None,
    ) -> int:
        """Make the written tables current, all at once. Returns the version."""
        if self.is_committed(run_id):
            raise AlreadyCommitted(f"run {run_id} has been committed before")
        version = (self.commits().agg(F.max("version")).first()[0] or 0) + 1
        rows = [
            (version, w.table, w.path, run_id, stream, window_end, w.buckets, w.bucket_columns,
             w.layout and w.layout.parts, w.layout and ",".join(w.layout.columns), w.part_paths)
            for w in written
        ]
        one = self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1)
        one.write.mode("append").parquet(self._commits)
        return version


def publish(rows: DataFrame, store: Store, table: str, run_id: str) -> int:
    """Write one table and make it current."""
    return store.commit([store.write(rows, table, run_id)], run_id)


@dataclass(frozen=True)
class Touched:
    """What :func:`publish_touched` did: the table as it is now, and the parts it wrote."""

    rows: DataFrame
    version: int
    rewritten: frozenset[int]
    parts: int


def publish_touched(
    store: Store,
    table: str,
    schema: T.StructType,
    run_id: str,
    layout: Layout,
    keys: DataFrame,
    change: Callable[[DataFrame], DataFrame],
) -> Touched:
    """Change the parts of a table that hold ``keys``, and leave all others as they are.

    ``keys`` has the layout's columns of every row that may change or be added; ``change`` maps
    the rows of their parts to the new ones. A table that is not in this layout yet is read and
    written as a whole.
    """
    touched = layout.of(keys) if store.layout(table) == layout else None
    old = store.read(table, schema) if touched is None else store.read_parts(table, schema, touched)
    written = store.write_parts(change(old), table, run_id, layout, touched)
    version = store.commit([written], run_id)
    return Touched(store.read(table, schema), version, written.rewritten, layout.parts)


def append_rejects(rejects: DataFrame | Iterable[DataFrame], store: Store, run_id: str) -> Written:
    """Write a run's rejects; they show once the run commits."""
    names = [f.name for f in S.REJECT_SCHEMA.fields]
    return store.write((some.select(*names) for some in _each(rejects)), "err_item", run_id)
