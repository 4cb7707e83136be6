"""Drop repeated rows without shuffling the rows that are not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldweave.operators.sizing import fits_in_memory

_DIGEST = ("_digest_a", "_digest_b")


def digested(rows: DataFrame) -> DataFrame:
    """Rows with 128 bits of digest over all columns, as two numbers."""
    first, second = F.xxhash64(*rows.columns), F.xxhash64(F.lit("second"), *rows.columns)
    return rows.withColumns(dict(zip(_DIGEST, (first, second), strict=True)))


def distinct_rows(rows: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``rows.distinct()``, for wide rows of which few are repeated.

    First the digests alone are shuffled, 16 bytes a row, and those seen more than once are
    written by ``stage`` (which writes a table under a name and reads it back). If they are few
    enough to be broadcast, a row whose digest came once goes on where it is, and only the others
    are shuffled and compared by value: rows that merely share a digest are all kept. If they are
    many, all rows are compared by value, as ``distinct`` does.

    ``rows`` are derived twice, so they should come from a table and not from a shuffle.
    """
    if not rows.columns:
        return rows.distinct()
    marked = digested(rows)
    again = marked.groupBy(*_DIGEST).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    again = stage(again.select(*_DIGEST), "repeated")
    if not fits_in_memory(again):
        return rows.distinct()
    joined = marked.join(F.broadcast(again.withColumn("_again", F.lit(True))), list(_DIGEST), "left")
    once = joined.where(F.col("_again").isNull()).select(*rows.columns)
    return once.unionByName(joined.where(F.col("_again")).select(*rows.columns).distinct())
