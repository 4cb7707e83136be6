"""Is a side small enough to broadcast? Answered by measuring, not by estimates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    """A side that was measured before."""

    rows: int
    bytes: int


def _width(f: T.StructField) -> Column:
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16
    # fixed-width values take 8 bytes in a row, wide decimals 16 more
    return F.lit(24 if isinstance(f.dataType, T.DecimalType) else 8)


def row_width(schema: T.StructType) -> Column:
    """Bytes that a row takes in memory, about."""
    return sum((_width(f) for f in schema.fields), F.lit(0)).cast("long")


def fits_in_memory(
    *sides: DataFrame | Size,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """True if all ``sides`` together are within both bounds.

    Rows are counted first (for Parquet that reads footers or key columns only);
    the exact width is summed only if the count is within bounds. Sides that were measured
    before cost nothing.
    """
    known = [s for s in sides if isinstance(s, Size)]
    others = [s for s in sides if not isinstance(s, Size)]
    rows, total = sum(s.rows for s in known), sum(s.bytes for s in known)
    if rows > max_rows or total > max_bytes:
        return False
    for df in others:
        rows += df.count()
        if rows > max_rows:
            return False
    for df in others:
        total += df.agg(F.coalesce(F.sum(row_width(df.schema)), F.lit(0)).alias("n")).first()["n"]
        if total > max_bytes:
            return False
    return True
