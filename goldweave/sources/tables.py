"""Typed reads of the item tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldweave import schema as S


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a stated schema: no inference, and unread columns stay on disk."""
    return spark.read.schema(schema).parquet(path)


def of_source(feed: DataFrame, source: str, column: str = "sys_source") -> DataFrame:
    """Rows of one source; a partition filter where the feed is partitioned by it."""
    return feed.where(F.col(column) == source)


def read_feed(spark: SparkSession, path: str, source: str) -> DataFrame:
    return of_source(read_table(spark, path, S.FEED_SCHEMA), source)


def read_changes(spark: SparkSession, path: str, arrived: str | None = None) -> DataFrame:
    """The message log; ``arrived`` names a column for the time at which a message's file was written."""
    log = read_table(spark, path, S.MESSAGE_SCHEMA)
    return log if arrived is None else log.withColumn(arrived, F.col("_metadata.file_modification_time"))


def deleted_rows(feed: DataFrame, state: str = "sys_ent_state") -> DataFrame:
    """Rows in the deleted state, of every source: give it the unfiltered feed."""
    return feed.where(F.col(state) == S.DELETED)


def flag_rows(feed: DataFrame, item: str = "item_id", flags: list[str] | None = None) -> DataFrame:
    """Distinct (item, flags) of one source's feed."""
    return feed.select(item, *(flags or S.FLAG_COLUMNS)).distinct()


def source_count(feed: DataFrame) -> DataFrame:
    return feed.agg(F.count(F.lit(1)).alias("in_rows"))
