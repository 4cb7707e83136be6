"""Insert-only load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.operators.collapse import has_all
from goldweave.operators.joins import join_unique
from goldweave.operators.sizing import fits_in_memory

DUPLICATE_KEY = 1
DUPLICATE_MESSAGE = "key is not unique among the new rows"


@dataclass(frozen=True)
class Loaded:
    """``inserted`` rows have the target's columns; ``duplicates`` those of the source."""

    inserted: DataFrame
    duplicates: DataFrame
    target: DataFrame


def insert_new(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    constants: dict[str, Column] | None = None,
    order: Sequence[str] = (),
    null_keys: str = "insert",
    distinct: bool = True,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> Loaded:
    """Insert rows whose key the target does not have; the first of a key gets in.

    Keys are looked up in the target as it was, so later rows of a new key are
    duplicates, not updates. They are told apart from the first by an
    aggregation and a join with its one row per key, in which Spark can split a
    hot key: a window function over the key would put its rows into one task. ``distinct=False`` is
    for rows that are distinct already.

    ``stage`` writes a table under a name and reads it back. With it, new keys are looked up
    first, from the key columns of both sides alone, and rows of known keys go no further if
    the new keys are few enough to be broadcast. The first rows are then built and written once,
    for ``inserted`` and ``duplicates`` alike; these are one more join, with the keys that came
    more than once only.
    """
    constants = constants or {}
    payload = [*keys, *[c for c in columns if c not in keys and c not in constants]]
    if distinct:
        rows = rows.select(*rows.columns).distinct()
    ranked = [*order, *[c for c in payload if c not in order and c not in keys]]
    rest = [c for c in rows.columns if c not in ranked and c not in keys]
    full = [*ranked, *rest]
    keyed = rows.where(has_all(keys))
    known = target.select(*keys)
    new = None
    if stage is not None:
        new = stage(keyed.select(*keys).distinct().join(known, list(keys), "left_anti"), "new-keys")
        if fits_in_memory(new):
            keyed, new = keyed.join(F.broadcast(new), list(keys), "left_semi").select(*rows.columns), None
            known = None
    # a row without other columns is its own first
    fresh = keyed.groupBy(*keys).agg(
        F.min(F.struct(*full) if full else F.struct(F.lit(True).alias("_seen"))).alias("_first"),
        F.count(F.lit(1)).alias("_times"),
    )
    if new is not None:
        fresh = fresh.join(new, list(keys), "left_semi")
    elif known is not None:
        fresh = fresh.join(known, list(keys), "left_anti")
    if stage is not None:
        fresh = stage(fresh, "new-rows")

    def shaped(source: DataFrame, where: dict[str, str]) -> DataFrame:
        return source.withColumns({f"_const_{c}": v for c, v in constants.items()}).selectExpr(
            *[
                f"CAST({where.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in target.schema.fields
            ]
        )

    by_key = {k: f"`{k}`" for k in keys} | {c: f"`_const_{c}`" for c in constants}
    inserted = shaped(fresh, {c: f"`_first`.`{c}`" for c in columns if c in full} | by_key)
    if null_keys == "insert":
        plain = {c: f"`{c}`" for c in columns if c in rows.columns}
        inserted = inserted.unionByName(shaped(rows.where(~has_all(keys)), plain | by_key))
    elif null_keys != "absent":
        raise ValueError(f"null_keys must be 'insert' or 'absent', not {null_keys!r}")

    # rows are distinct, so only the first itself equals the first
    again = fresh.where(F.col("_times") > 1).drop("_times")
    others = join_unique(keyed, again, keys, "inner").where(
        ~F.struct(*full).eqNullSafe(F.col("_first")) if full else F.lit(False)
    )
    duplicates = others.select(*rows.columns)
    return Loaded(inserted, duplicates, target.unionByName(inserted))
