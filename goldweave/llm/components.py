"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.operators.joins import join_unique
from goldweave.session import scratch


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour that is larger than a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # The edges of a hub are split in this join.
    return join_unique(both, least, ["a"], "inner").where(F.col("b") > F.col("a")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    others = join_unique(down, least, ["a"], "inner").where(F.col("b") != F.col("m")) \
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(others).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for edges ``a``, ``b``.

    Every round is written to the shared folder and read back, so a lost executor costs a
    round at most. Only a count and a checksum per round reach the driver.
    """
    spark = edges.sparkSession
    schema = edges.select("a", "b").schema
    before = None
    current = edges.select("a", "b").where(F.col("a") != F.col("b"))
    while True:
        path = scratch(spark, name)
        _small(_large(current)).write.parquet(path)
        current = spark.read.schema(schema).parquet(path)
        # Half of each hash, so that the sum of a great many does not overflow.
        state = current.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 32))).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
