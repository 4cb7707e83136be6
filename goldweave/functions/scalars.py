"""Scalar expressions. All are built-in Spark functions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldweave.schema import SEQUENCE_LIMIT

ColumnOrName = Column | str

# One or two digits for month, day and time; the offset as +HH:MM.
OFFSET_FORMAT = "y-M-d H:m:s xxx"
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """Strip spaces; a text with nothing left is NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def try_parse_offset_ts(c: ColumnOrName) -> Column:
    """Instant of a text such as ``2024-01-31 09:05:00 -05:00``; NULL if it does not parse."""
    return F.try_to_timestamp(F.nullif(_col(c), F.lit("")), F.lit(OFFSET_FORMAT))


def is_bad_offset_date(c: ColumnOrName) -> Column:
    """True for a text that is there but does not parse."""
    return F.nullif(_col(c), F.lit("")).isNotNull() & try_parse_offset_ts(c).isNull()


def parse_offset_ts(c: ColumnOrName, name: str = "date") -> Column:
    """As :func:`try_parse_offset_ts`, but a text that does not parse fails the job.

    The failure is raised explicitly, so it does not depend on the session's
    ANSI setting.
    """
    c = _col(c)
    message = F.concat(F.lit(f"{name} is not a date with an offset: "), c)
    there = F.nullif(c, F.lit("")).isNotNull()
    return F.coalesce(
        try_parse_offset_ts(c), F.when(there, F.raise_error(message).cast("timestamp"))
    )


def round_to_hour(c: ColumnOrName) -> Column:
    """Nearest whole hour; the half hour goes up."""
    return F.date_trunc("HOUR", _col(c) + F.expr("INTERVAL 30 MINUTES"))


def timestamp_text(c: ColumnOrName) -> Column:
    return F.date_format(_col(c), TEXT_FORMAT)


def concat_text(*parts: ColumnOrName) -> Column:
    """Concatenate; a NULL part counts as empty."""
    return F.concat_ws("", *[_col(p) for p in parts])


def next_sequence(highest: ColumnOrName, limit: int = SEQUENCE_LIMIT) -> Column:
    """Highest sequence seen, 0 if there is none or it has reached the limit."""
    highest = _col(highest)
    return F.coalesce(F.when(highest == limit, F.lit(0)).otherwise(highest), F.lit(0))


def stride_seconds(per_day: ColumnOrName) -> Column:
    """Whole seconds between two windows at ``per_day`` windows a day."""
    return F.round(F.lit(86400) / _col(per_day)).cast("long")
