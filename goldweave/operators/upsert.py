"""Apply one or more sources to a target table; the result is the new target.

Plain Parquet tables cannot be merged into in place, so a merge is a function
from the old snapshot to the new one. However many sources there are, the
target is joined once: the sources are collapsed together to one row per key
and their rules are then folded over the joined row, in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.operators.collapse import MergeSource, collapse_many, has_all
from goldweave.operators.joins import join_unique

_KNOWN = "_known"
INSERTED_BY = "load_inserted_by"


def rows_column(name: str) -> str:
    """Tally column: rows of source ``name`` that went into a target row."""
    return f"load_rows_{name}"


def _fold(
    joined: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    sources: Sequence[MergeSource],
    tally: bool,
) -> DataFrame:
    """Walk the sources in order over each joined row.

    A match is told by a flag, never by a value: a matched NULL overwrites. The
    expressions are stated as SQL text: a wide table has many of them, and each
    is then one call to the JVM.
    """
    added: dict[str, Column] = {}
    tally = tally or INSERTED_BY in columns
    there = F.col(_KNOWN).isNotNull()
    for s in sources:
        hit = F.col(s.last).isNotNull()
        added[f"_new_{s.name}"] = hit & ~there if s.insert else F.lit(False)
        added[f"_hit_{s.name}"] = hit if s.insert else hit & there
        added |= {f"_const_{s.name}_{c}": v for c, v in s.constants.items()}
        if s.insert:
            there = there | hit
    types = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    joined = joined.where(there).withColumns(added)

    def value(s: MergeSource, c: str, row: str) -> str:
        return f"`_const_{s.name}_{c}`" if c in s.constants else f"`{row}`.`{c}`"

    def folded(c: str) -> str:
        branches = []
        for s in sources:
            if c in s.update:
                branches.append(f"WHEN `_hit_{s.name}` THEN {value(s, c, s.last)}")
            elif c in s.insert:
                branches.append(f"WHEN `_new_{s.name}` THEN {value(s, c, s.first)}")
        if not branches:
            return f"`{c}`"
        # the last source to write wins, so its branch is tried first
        chain = " ".join(reversed(branches))
        return f"CAST(CASE {chain} ELSE `{c}` END AS {types[c]}) AS `{c}`"

    out = [f"`{c}`" if c in keys else folded(c) for c in columns if c != INSERTED_BY]
    if tally:
        inserted = " ".join(f"WHEN `_new_{s.name}` THEN '{s.name}'" for s in sources)
        before = f"`{INSERTED_BY}`" if INSERTED_BY in columns else "NULL"
        out.append(f"coalesce({before}, CASE {inserted} END) AS `{INSERTED_BY}`")
        out += [
            f"CASE WHEN `_hit_{s.name}` THEN `{s.count}` END AS `{rows_column(s.name)}`"
            for s in sources
        ]
    return joined.selectExpr(*out)


def _keyless(source: MergeSource, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL key match nothing, so each is an insert of its own."""
    rows = source.rows.where(~has_all(keys)).withColumns(source.constants)
    return rows.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in source.insert else 'NULL'} AS "
            f"{f.dataType.simpleString()}) AS `{f.name}`"
            for f in target.schema.fields
        ]
    )


def merge(
    target: DataFrame,
    sources: Sequence[MergeSource],
    keys: Sequence[str],
    *,
    small_sources: bool = False,
    unique_target: bool = True,
    null_keys: str = "insert",
    tally: bool = False,
) -> DataFrame:
    """New target after applying ``sources`` in order.

    ``small_sources=True`` is for sources whose size has been checked (see
    :func:`goldweave.operators.sizing.fits_in_memory`): they are broadcast and
    the target is not shuffled. Otherwise the target is shuffled once, by
    ``keys``; those are unique in it, so no partition runs hot. Sources that only
    update may go by part of the key: then ``unique_target=False`` lets Spark
    split the rows of a hot one.

    ``null_keys``: ``'insert'`` adds every source row with a NULL key as it is;
    ``'absent'`` says that a reject rule has taken them out, and saves looking.

    ``tally=True`` adds columns that tell which source inserted a row and how
    many source rows went into it, for exact counts of what was written.
    """
    if null_keys not in ("insert", "absent"):
        raise ValueError(f"null_keys must be 'insert' or 'absent', not {null_keys!r}")
    inserting = [s for s in sources if s.insert]
    source = collapse_many(sources, keys)
    known = target.withColumn(_KNOWN, F.lit(True))
    if small_sources:
        joined = known.join(F.broadcast(source), list(keys), "left")
        if inserting:
            # Only keys of the small side can match, so the probe of the target
            # reads its key columns and keeps at most as many keys as that side has.
            matched = target.select(*keys).join(
                F.broadcast(source.select(*keys)), list(keys), "left_semi"
            )
            fresh = source.join(F.broadcast(matched.distinct()), list(keys), "left_anti")
            joined = joined.unionByName(fresh, allowMissingColumns=True)
    elif inserting:
        joined = known.join(source, list(keys), "full")
    elif unique_target:
        joined = known.join(source, list(keys), "left")
    else:
        joined = join_unique(known, source, keys, "left")
    result = _fold(joined, target.columns, keys, sources, tally)
    if null_keys == "insert" and inserting:
        parts = [_keyless(s, target, keys) for s in inserting]
        if tally:
            parts = [
                p.withColumns({INSERTED_BY: F.lit(s.name), rows_column(s.name): F.lit(1).cast("long")})
                for p, s in zip(parts, inserting, strict=True)
            ]
        result = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, result
        )
    return result


def upsert(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    insert: Sequence[str],
    *,
    order: Sequence[str] = (),
    constants: dict[str, Column] | None = None,
    small_source: bool = False,
    null_keys: str = "insert",
    tally: bool = False,
) -> DataFrame:
    """Merge one source: matched keys take ``update`` columns, new ones ``insert`` columns."""
    source = MergeSource(
        "source", rows, update=update, insert=insert, order=order, constants=constants or {}
    )
    return merge(
        target, [source], keys, small_sources=small_source, null_keys=null_keys, tally=tally
    )
