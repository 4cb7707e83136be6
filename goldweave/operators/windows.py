"""Incremental windows on creation time.

A control row holds the bounds of the next window. Windows follow each other at
a fixed stride; both ends belong to a window, so a row on a boundary is in two.
A window is due once it ended at least two strides before the last completed
sync. All due windows are handled in one pass: rows are tagged with the numbers
of their windows by arithmetic, so there is no loop and no range join.

Times are whole seconds apart from the stored bounds themselves, which may have
a fraction: window 0 is exactly the stored one, window 1 starts at its end, and
the ends of windows 1, 2, .. are counted from that end cut to the second.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.functions import round_to_hour, stride_seconds

_SECOND = 1_000_000


def micros(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def _cut(us: Column) -> Column:
    """Cut microseconds to the whole second."""
    return us - F.pmod(us, F.lit(_SECOND))


def due_windows(control: DataFrame, per_day: Column, now: Column) -> DataFrame:
    """Add to each control row its window plan.

    ``window_start, window_end`` (defaults: the stride before ``now``'s nearest
    hour), ``stride_s``, ``due`` (number of windows to run) and ``next_start,
    next_end``, the bounds to store afterwards.

    A missing sync time, or a frequency that is missing or not positive, fails
    the job: no window could ever be found due, or all of them would be.
    """
    hour = round_to_hour(now)
    stride = stride_seconds(per_day)
    checked = (
        F.when(
            per_day.isNull() | (per_day <= 0) | (stride <= 0),
            F.raise_error(F.lit("the job frequency must be a positive number of runs a day")).cast("long"),
        )
        .when(
            F.col("sync_up_date").isNull(),
            F.raise_error(F.lit("the control row has no sync time")).cast("long"),
        )
        .otherwise(stride)
    )
    planned = control.withColumn("stride_s", checked)
    stride_us = F.col("stride_s") * _SECOND
    planned = planned.withColumns(
        {
            "_start": F.coalesce(micros("start_time"), micros(hour) - stride_us),
            "_end": F.coalesce(micros("end_time"), micros(hour)),
        }
    )
    end, last = F.col("_end"), _cut(micros("sync_up_date")) - 2 * stride_us
    spare = last - _cut(end)
    due = F.when(spare < 0, F.lit(0)).otherwise(F.expr("1") + _div(spare, stride_us)).cast("long")
    planned = planned.withColumn("due", due)
    # bounds after the last window that ran
    n = F.col("due")
    reached = _cut(end) + (n - 1) * stride_us
    next_start = (
        F.when(n == 0, micros("start_time")).when(n == 1, end).otherwise(reached)
    )
    next_end = F.when(n == 0, micros("end_time")).otherwise(reached + stride_us)
    return planned.withColumns(
        {
            "window_start": F.timestamp_micros("_start"),
            "window_end": F.timestamp_micros("_end"),
            "next_start": F.timestamp_micros(next_start),
            "next_end": F.timestamp_micros(next_end),
        }
    ).drop("_start", "_end")


def _div(a: Column, b: Column) -> Column:
    """Integer division of numbers that are not negative."""
    return ((a - F.pmod(a, b)) / b).cast("long")


@dataclass(frozen=True)
class Windows:
    """``n`` windows: the stored one, then strides from its end. Times in microseconds."""

    start: int
    end: int
    stride_s: int
    n: int

    @classmethod
    def of(cls, planned: DataFrame) -> Windows:
        """Bounds of the one row of a :func:`due_windows` result."""
        row = planned.select(
            F.unix_micros("window_start").alias("start"),
            F.unix_micros("window_end").alias("end"),
            "stride_s",
            "due",
        ).first()
        return cls(row["start"], row["end"], row["stride_s"], row["due"])

    @property
    def stride(self) -> int:
        return self.stride_s * _SECOND

    @property
    def anchor(self) -> int:
        return self.end - self.end % _SECOND

    @property
    def last_end(self) -> int:
        """End of the last window."""
        return self.end if self.n <= 1 else self.anchor + (self.n - 1) * self.stride

    def end_of(self, number: Column) -> Column:
        """End of the numbered window, as a timestamp."""
        us = F.when(number == 0, F.lit(self.end)).otherwise(
            F.lit(self.anchor) + number * self.stride
        )
        return F.timestamp_micros(us.cast("long"))

    def covers(self, at: Column | str) -> Column:
        """Within the due windows as a whole; a plain range, so it reaches the scan."""
        at = F.col(at) if isinstance(at, str) else at
        if self.n == 0:
            return F.lit(False)
        return at.between(
            F.timestamp_micros(F.lit(self.start)), F.timestamp_micros(F.lit(self.last_end))
        )

    def numbers(self, at: Column | str) -> Column:
        """Array of the numbers of the windows that hold a time (two on a boundary)."""
        us = micros(at)
        in_first = us.between(F.lit(self.start), F.lit(self.end))
        past = us - self.anchor
        below = _div(past, F.lit(self.stride))
        above = F.when(F.pmod(past, F.lit(self.stride)) == 0, below).otherwise(below + 1)
        later = F.filter(
            F.array_distinct(F.array(above, below + 1)), lambda k: (k >= 1) & (k < self.n)
        )
        empty = F.array().cast("array<bigint>")
        first = F.when(in_first, F.array(F.lit(0).cast("long"))).otherwise(empty)
        rest = F.when(us >= self.end, later).otherwise(empty)
        return F.concat(first, rest) if self.n > 0 else empty

    def tag(self, rows: DataFrame, at: str, number: str = "window") -> DataFrame:
        """Rows of the due windows, each once per window that holds it."""
        return rows.where(self.covers(at)).withColumn(number, F.explode(self.numbers(at)))


def advance(control: DataFrame, planned: DataFrame, sync_id: str) -> DataFrame:
    """Control rows with the bounds of one sync id moved past its due windows."""
    moved = planned.where(F.col("sync_up_id") == sync_id).select(
        "sync_up_id", "next_start", "next_end", F.lit(True).alias("_moved")
    )
    joined = control.join(moved, "sync_up_id", "left")
    return joined.select(
        *[
            F.when(F.col("_moved"), F.col({"start_time": "next_start", "end_time": "next_end"}[c]))
            .otherwise(F.col(c))
            .alias(c)
            if c in ("start_time", "end_time")
            else F.col(c)
            for c in control.columns
        ]
    )
