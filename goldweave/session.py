"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
import warnings
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a load sets on its session while it runs. What is broadcast without a hint is chosen by
# the bytes that were shuffled, never by those of files: a table of many nearly empty columns is so
# small on disk that Spark would take the keys of all its rows for a few megabytes.
LOAD_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Wide rows take some fifteen times their bytes in files and shuffles once they are sorted in
    # memory: a task gets few enough of them not to spill.
    "spark.sql.files.maxPartitionBytes": "4MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    # Generated methods for wide rows are long; the JVM interprets one of more than 8,000 bytes
    # for good, so Spark is to generate it in smaller pieces.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings of a whole job. Its rows are dealt to so many folders or buckets at a time as they come,
# not sorted by them first.
JOB_SETTINGS = LOAD_SETTINGS | {"spark.sql.maxConcurrentOutputFileWriters": "8"}

# Writer options of wide tables, of which several versions lie on disk beside each other.
COMPRESSED = {"compression": "zstd"}
# Those of a wide table that is read as a whole: minima and maxima cost something for each value,
# and nobody skips rows by them.
READ_WHOLE = COMPRESSED | {"parquet.column.statistics.enabled": "false"}

# Folders of the tables staged for a job, if they go with it.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in LOAD_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def load_settings(spark: SparkSession):
    """The settings of a job that loads, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in JOB_SETTINGS}
    try:
        for key, value in JOB_SETTINGS.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else the folder set on the
    context for checkpoints, else the warehouse.

    All are resolved by Spark's file systems, so every executor reaches them. A warehouse on one
    machine's disk will not do for a cluster: it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _set_on_context(spark)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if _is_cluster(spark) and _on_disk(spark, folder):
            raise ValueError(
                f"set spark.checkpoint.dir to a folder that all machines share: {folder} is one machine's")
    return folder.rstrip("/")


def _is_cluster(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.master", "local").startswith("local")


def _set_on_context(spark: SparkSession) -> str | None:
    return spark.sparkContext.getCheckpointDir() if hasattr(spark, "sparkContext") else None


def _on_disk(spark: SparkSession, folder: str) -> bool:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getScheme() == "file"


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that was never used before."""
    return f"{shared_folder(spark)}/goldweave/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write rows to the shared folder and read them back: used several times, computed once.

    A lost executor then costs a read of the table, not the work that led to it. With ``by`` the
    rows of each value of that column, the last one, have a folder of their own.
    """
    spark = rows.sparkSession
    path = scratch(spark, name)
    if _passing.get() is not None:
        _passing.get().append(path)
    writer = rows.write.options(**READ_WHOLE)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession):
    """Tables staged meanwhile are deleted at the end: for a job that hands on no rows of them."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    except Exception as e:  # the job has ended: what is left is in nobody's way
        warnings.warn(f"staged table {folder} was not deleted: {e}", stacklevel=2)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of statements that have ended.

    It keeps them while their plans are in the driver's memory, and a driver with memory to spare
    collects garbage late: the files of all steps of a job would lie on disk together.
    """
    spark._jvm.java.lang.System.gc()
