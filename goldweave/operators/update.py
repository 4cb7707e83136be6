"""Updates of rows that are already there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave import schema as S
from goldweave.operators.collapse import MergeSource, collapse
from goldweave.operators.joins import join_unique
from goldweave.operators.upsert import merge


def update_by_key(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    constants: dict[str, Column] | None = None,
    order: Sequence[str] = (),
    small_source: bool = False,
    unique_target: bool = False,
    tally: bool = False,
) -> DataFrame:
    """Set ``columns`` on every target row with a key in ``rows``; the last row of a key wins.

    The target may have many rows per key, also very many: they are split.
    ``unique_target=True`` is for a whole key, and spares one shuffle of ``rows``.
    """
    constants = constants or {}
    source = MergeSource(
        "source", rows, update=[*columns, *constants], constants=constants, order=order
    )
    return merge(
        target, [source], keys, small_sources=small_source, unique_target=unique_target, tally=tally
    )


def expand_to_keys(
    rows: DataFrame, by: Sequence[str], columns: Sequence[str], *keyed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Turn an update by part of the key into one by the whole key.

    The last row per ``by`` is joined to the ``keys`` of the ``keyed`` tables.
    Only key columns of those are read and shuffled, so an update of every
    revision of an item can share the one wide join of a merge.
    """
    last = collapse(rows, by, updated=columns)
    every = keyed[0].select(*keys)
    for other in keyed[1:]:
        every = every.unionByName(other.select(*keys))
    return join_unique(every, last, by, "inner").select(*keys, *columns)


def soft_delete(
    target: DataFrame,
    deleted: DataFrame,
    keys: Sequence[str] = S.KEYS,
    *,
    state: str = "sys_ent_state",
    constants: dict[str, Column] | None = None,
    small_source: bool = False,
) -> DataFrame:
    """Copy the deleted state (and stamp ``constants``) onto rows with a key in ``deleted``."""
    return update_by_key(
        target, deleted, keys, [state], constants=constants, small_source=small_source,
        unique_target=True,
    )
