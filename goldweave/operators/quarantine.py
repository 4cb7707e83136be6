"""Reject rules: rows that break one are set aside with their reasons."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave import schema as S
from goldweave.functions import is_bad_offset_date

BROKEN = "_broken"


@dataclass(frozen=True)
class Rule:
    """``failed`` is true for a row that breaks the rule; NULL counts as kept.

    It is a SQL condition, or a function that builds one, so that rules can be
    stated before there is a session.
    """

    code: int
    message: str
    failed: str | Callable[[], Column]

    @property
    def condition(self) -> Column:
        return F.expr(self.failed) if isinstance(self.failed, str) else self.failed()


def not_null(code: int, column: str) -> Rule:
    """Empty text counts as missing, as in the source system."""
    return Rule(
        code, f"{column} is missing",
        lambda: F.col(column).isNull() | (F.col(column).cast("string") == ""),
    )


def max_length(code: int, column: str, length: int) -> Rule:
    return Rule(
        code, f"{column} is longer than {length}", lambda: F.char_length(F.col(column)) > length
    )


def castable(code: int, column: str, to: str) -> Rule:
    def bad() -> Column:
        return F.col(column).isNotNull() & F.col(column).try_cast(to).isNull()

    return Rule(code, f"{column} is not a {to}", bad)


def offset_date(code: int, column: str) -> Rule:
    return Rule(
        code, f"{column} is not a date with an offset", lambda: is_bad_offset_date(column)
    )


def _broken(rules: Sequence[Rule]) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(
                    r.condition,
                    F.struct(F.lit(r.code).cast("long").alias("code"), F.lit(r.message).alias("message")),
                )
                for r in rules
            ]
        )
    )


def split_rejects(rows: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). A rejected row has the code of its first broken rule and all messages.

    Both sides are plain filters of ``rows``: accepted rows go on without being
    written first, and neither side needs a shuffle.
    """
    if not rules:
        none = rows.where(F.lit(False)).withColumns(
            {"sys_err_code": F.lit(None).cast("long"), "sys_err_mesg": F.lit(None).cast("string")}
        )
        return rows, none
    fails = F.lit(False)
    for r in rules:
        fails = fails | F.coalesce(r.condition, F.lit(False))
    accepted = rows.where(~fails)
    rejected = (
        rows.where(fails)
        .withColumn(BROKEN, _broken(rules))
        .withColumns(
            {
                "sys_err_code": F.col(BROKEN)[0]["code"],
                "sys_err_mesg": F.array_join(F.col(BROKEN)["message"], "; "),
            }
        )
        .drop(BROKEN)
    )
    return accepted, rejected


def as_rejects(
    rejected: DataFrame, step: str, run_id: str, run_ts: Column,
    constants: dict[str, Column] | None = None,
) -> DataFrame:
    """Any step's rejected rows in the one shape of the reject table.

    Rows keep what they have; ``constants`` are what a step writes in its place.
    """
    fixed = {
        "step": F.lit(step),
        "run_id": F.lit(run_id),
        "sys_nc_type": F.lit("INSERT"),
        S.CREATED: run_ts,
        S.MODIFIED: run_ts,
        **(constants or {}),
    }

    def column(f) -> str:
        there = f.name in fixed or f.name in rejected.columns
        value = f"`{f.name}`" if there else "NULL"
        return f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`"

    return rejected.withColumns(fixed).selectExpr(*[column(f) for f in S.REJECT_SCHEMA.fields])
