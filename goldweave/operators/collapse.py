"""Many source rows per key to one.

Rows of a source are meant to be applied one at a time, in order: the first row
of an unknown key inserts it, each later one updates it. The outcome needs only
two rows per key, the first (for columns that only an insert sets) and the last
(for columns an update sets), so a source collapses to those two in one
aggregation. ``min``/``max`` over a struct combine on the map side: a key that
holds a third of all rows reaches the shuffle as one row per map task. If both are
ranked alike they are taken of one struct, so a wide row is sorted with one copy of itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MergeSource:
    """Rows to apply to a target, and which target columns they own.

    ``insert`` is empty for a source that only updates rows that are there.
    ``constants`` are values that do not depend on the row (stamps, literals);
    they are filled in after the shuffle instead of travelling through it.
    ``order`` comes first in the order of application; the payload columns
    follow, NULLs first, which makes it total. ``first_by``/``last_by`` replace
    ``order`` where a row is applied several times and the first and the last
    application are ranked by different columns.
    """

    name: str
    rows: DataFrame
    update: Sequence[str]
    insert: Sequence[str] = ()
    constants: dict[str, Column] = field(default_factory=dict)
    order: Sequence[str] = ()
    first_by: Sequence[str] | None = None
    last_by: Sequence[str] | None = None
    weight: str | None = None

    def check(self, keys: Sequence[str]) -> None:
        overlap = set(keys) & set(self.update)
        if overlap:
            raise ValueError(f"{self.name}: keys cannot be updated: {sorted(overlap)}")
        if self.insert and not set(self.update) <= set(self.insert):
            missing = sorted(set(self.update) - set(self.insert))
            raise ValueError(f"{self.name}: updated but never inserted: {missing}")

    def payload(self, keys: Sequence[str]) -> list[str]:
        columns = list(dict.fromkeys([*self.insert, *self.update]))
        return [c for c in columns if c not in keys and c not in self.constants]

    def insert_only(self, keys: Sequence[str]) -> list[str]:
        return [c for c in self.insert if c not in keys and c not in self.update]

    @property
    def first(self) -> str:
        return f"_first_{self.name}"

    @property
    def last(self) -> str:
        return f"_last_{self.name}"

    @property
    def count(self) -> str:
        return f"_rows_{self.name}"


def _ranked(order: Sequence[str], payload: Sequence[str]) -> Column:
    fields = [*order, *[c for c in payload if c not in order]]
    # a row without payload still has to be seen
    return F.struct(*fields) if fields else F.struct(F.lit(True).alias("_seen"))


def _needs_first(source: MergeSource, keys: Sequence[str]) -> bool:
    return any(c not in source.constants for c in source.insert_only(keys))


def _needs_last(source: MergeSource) -> bool:
    return any(c not in source.constants for c in source.update)


def _orders(source: MergeSource) -> tuple[list[str], list[str]]:
    first_by = source.order if source.first_by is None else source.first_by
    last_by = source.order if source.last_by is None else source.last_by
    return list(first_by), list(last_by)


def _ranked_alike(source: MergeSource) -> bool:
    """First and last row are the ends of one order."""
    first_by, last_by = _orders(source)
    return _needs_last(source) and first_by == last_by


def _tagged(source: MergeSource, keys: Sequence[str]) -> DataFrame:
    payload = source.payload(keys)
    first_by, last_by = _orders(source)
    weight = F.lit(1) if source.weight is None else F.col(source.weight)
    last = _ranked(last_by, payload) if _needs_last(source) else _ranked((), ())
    columns = [last.alias(source.last), weight.cast("long").alias(source.count)]
    if _needs_first(source, keys) and not _ranked_alike(source):
        columns.append(_ranked(first_by, payload).alias(source.first))
    return source.rows.select(*keys, *columns)


def has_all(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def collapse_many(sources: Sequence[MergeSource], keys: Sequence[str]) -> DataFrame:
    """One row per key over all sources: per source its first row, last row and row count.

    One shuffle for all of them. Rows with a NULL key are left out (they match
    nothing, and grouping would treat them as one key).
    """
    aggregates = []
    for s in sources:
        s.check(keys)
        aggregates.append(F.max(s.last).alias(s.last))
        aggregates.append(F.sum(s.count).alias(s.count))
        if _needs_first(s, keys):
            aggregates.append(F.min(s.last if _ranked_alike(s) else s.first).alias(s.first))
    tagged = [_tagged(s, keys).where(has_all(keys)) for s in sources]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return rows.groupBy(*keys).agg(*aggregates)


def collapse(
    rows: DataFrame,
    keys: Sequence[str],
    *,
    insert_only: Sequence[str] = (),
    updated: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key: ``insert_only`` columns of its first row, ``updated`` ones of its last."""
    source = MergeSource(
        "s", rows, update=list(updated), insert=[*keys, *insert_only, *updated], order=order
    )
    one = collapse_many([source], keys)
    return one.select(
        *keys,
        *[F.col(source.first)[c].alias(c) for c in insert_only],
        *[F.col(source.last)[c].alias(c) for c in updated],
    )
