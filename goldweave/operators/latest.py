"""Latest message per item inside a time window.

The highest sequence number is looked up inside the window, but the messages it
stands for are taken from the whole log: one with the winning number and a
creation time outside the window counts too, and ties are all kept.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.operators.filters import key_filter
from goldweave.operators.joins import join_unique
from goldweave.operators.windows import Windows


def latest_in_window(
    messages: DataFrame,
    start: Column,
    end: Column,
    *,
    item: str = "item",
    seq: str = "seq_num",
    at: str = "sys_creation_date",
) -> DataFrame:
    """Messages that carry their item's highest number of the window, both ends included."""
    highest = (
        messages.where(F.col(at).between(start, end))
        .groupBy(item)
        .agg(F.max(seq).alias(seq))
    )
    # one equi-join on (item, number), which also spreads the messages of a hot item
    return messages.join(highest, [item, seq], "inner").select(*messages.columns)


def window_maxima(
    messages: DataFrame,
    windows: Windows,
    *,
    item: str = "item",
    seq: str = "seq_num",
    at: str = "sys_creation_date",
) -> DataFrame:
    """Highest number per (window, item) over all due windows, in one aggregation."""
    tagged = windows.tag(messages.select(item, seq, at), at)
    return tagged.groupBy("window", item).agg(F.max(seq).alias(seq))


def catch_up(
    messages: DataFrame,
    maxima: DataFrame,
    *,
    item: str = "item",
    seq: str = "seq_num",
    window: str = "window",
    prefilter: bool = True,
) -> DataFrame:
    """Messages that win in some window, with ``first_window, last_window, times``.

    A number that wins in many windows is applied in each of them, but only its
    first and its last application can show in the outcome. Folding the maxima
    to one row per (item, number) keeps the join from repeating a message once
    per window.

    The log is wide and few of its messages win. With ``prefilter`` those that cannot are left
    out where they are read, by a bitmap of the winners of bounded size, and are not shuffled.
    """
    spans = maxima.where(F.col(item).isNotNull() & F.col(seq).isNotNull()).groupBy(item, seq).agg(
        F.min(window).alias("first_window"),
        F.max(window).alias("last_window"),
        F.count("*").alias("times"),
    )
    held = key_filter(messages, spans, [item, seq]) if prefilter else messages
    return join_unique(held, spans, [item, seq], "inner").select(
        *messages.columns, "first_window", "last_window", "times"
    )


def late_messages(
    messages: DataFrame,
    windows: Windows,
    arrived: Column,
    *,
    at: str = "sys_creation_date",
) -> DataFrame:
    """Messages that arrived after their window was handled, once per such window.

    A window is handled two strides after its end; what arrives later is not looked at again.
    Adds ``window`` and ``window_end``. Two filters and an expression: nothing is shuffled.
    """
    tagged = windows.tag(messages.withColumn("_arrived", arrived), at)
    ended = tagged.withColumn("window_end", windows.end_of(F.col("window")))
    handled = F.unix_micros("window_end") + 2 * windows.stride
    return ended.where(F.unix_micros("_arrived") > handled).drop("_arrived")
