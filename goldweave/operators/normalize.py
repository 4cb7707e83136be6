"""Feed and message projections."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave import schema as S
from goldweave.functions import blank_to_null, parse_offset_ts, try_parse_offset_ts
from goldweave.operators.distinct import distinct_rows


def normalize_feed(
    feed: DataFrame,
    columns: Sequence[str] = S.FEED_COLUMNS,
    *,
    trimmed: Sequence[str] = S.TRIMMED,
    dates: Sequence[str] = S.OFFSET_DATES,
    bad_dates: str = "abort",
    distinct: bool = True,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Trim, parse offset dates, keep ``columns`` and drop repeated rows.

    ``bad_dates='abort'`` fails the job on a date that does not parse;
    ``'null'`` is for rows that a reject rule has already checked.

    Dropping repeated rows shuffles by the whole row, so no key can make a hot
    partition. ``collapse`` gives the same result with or without it: pass
    ``distinct=False`` to save that shuffle where only the merged table
    matters and not the number of distinct rows. With ``stage`` only rows that
    are repeated are shuffled as a whole (:func:`goldweave.operators.distinct.distinct_rows`).
    """
    if bad_dates not in ("abort", "null"):
        raise ValueError(f"bad_dates must be 'abort' or 'null', not {bad_dates!r}")

    def project(c: str) -> Column:
        if c in trimmed:
            return blank_to_null(c).alias(c)
        if c in dates:
            parsed = parse_offset_ts(c, c) if bad_dates == "abort" else try_parse_offset_ts(c)
            return parsed.alias(c)
        return F.col(c)

    rows = feed.select(*[project(c) for c in columns])
    if not distinct:
        return rows
    return rows.distinct() if stage is None else distinct_rows(rows, stage)


def project_messages(
    messages: DataFrame,
    renames: dict[str, str] | None = None,
    *,
    extra: Sequence[str] = (),
    distinct: bool = True,
) -> DataFrame:
    """Message columns under their master names, plus ``extra`` ones as they are."""
    renames = renames or S.MESSAGE_TO_MASTER
    rows = messages.select(*[F.col(a).alias(b) for a, b in renames.items()], *extra)
    return rows.distinct() if distinct else rows


def message_insert_defaults(run_ts: Column, user: str) -> dict[str, Column]:
    """Values of a master row born from a change message that no message carries."""
    return {
        "item_type": F.lit(S.MESSAGE_ITEM_TYPE),
        "sys_ent_state": F.lit(S.ACTIVE),
        "sys_created_by": F.lit(user),
        "sys_last_modified_by": F.lit(user),
        **stamps(run_ts),
    }


def stamps(run_ts: Column) -> dict[str, Column]:
    """Both audit dates; a merge sets the creation date on insert only."""
    return {S.CREATED: run_ts, S.MODIFIED: run_ts}
