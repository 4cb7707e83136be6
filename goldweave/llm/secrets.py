"""Secrets in texts: fixed patterns, and windows of high entropy in candidate strings.

DataFrame functions only. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.llm.tables import pick

# Fixed patterns and their names, in the order in which spans that start together are listed.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
MIN_VALUE = 6

# Fixed values of the allow-list: examples in manuals, and identifiers that are no secret.
ALLOWED = (
    "(?i)example|placeholder|changeme|dummy|sample",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)


@dataclass(frozen=True)
class CharacterClass:
    """Candidate strings of one alphabet.

    A candidate is a run of the alphabet with at least ``window`` characters that matches all
    of ``needs``. A window is reported if its entropy in bits is at least ``bits``.
    """

    name: str
    alphabet: str
    run: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()

    @property
    def pattern(self) -> str:
        return f"(?<!{self.run}){self.run}{{{self.window},}}"


CLASSES = (
    CharacterClass("hex_entropy", "0123456789abcdefABCDEF", "[0-9a-fA-F]", 20, 3.01,
                   ("[0-9]", "[a-fA-F]")),
    CharacterClass(
        "base64_entropy",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        "[A-Za-z0-9+/_-]", 24, 3.91, ("[0-9]", "[A-Z]", "[a-z]")),
)

_SCALE = 1 << 20
_SPAN = "array<struct<start:int,end:int>>"


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, matches: Column, pattern: str) -> Column:
    """Spans of all matches, from the lengths of the gaps between them and of the matches."""
    gaps = F.split(text, pattern, -1)
    walked = F.aggregate(
        F.arrays_zip(F.transform(F.slice(gaps, 1, F.size(matches)), F.length).alias("gap"),
                     F.transform(matches, F.length).alias("size")),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"),
                (acc["at"] + x["gap"] + x["size"]).alias("end")))).alias("spans")),
    )
    return F.when(F.size(matches) > 0, walked["spans"]).otherwise(F.array().cast(_SPAN))


def entropy_spans(candidate: Column, kind: CharacterClass) -> Column:
    """Spans inside a candidate that are covered by windows of high entropy.

    The counts of the characters in the window go from one window to the next: one character
    comes in, one goes out. With ``f(n) = n log2 n`` in whole numbers, so that nothing drifts,
    the entropy is at least ``bits`` when the sum of ``f`` over the counts is small enough.
    """
    w = kind.window
    f = F.array(*[F.lit(round(n * math.log2(n) * _SCALE) if n else 0).cast("long")
                  for n in range(w + 2)])
    most = math.floor(w * (math.log2(w) - kind.bits) * _SCALE)
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(kind.alphabet), c))
    # Each step is the character that comes in and, once the window is full, the one to go.
    gone_by = F.concat(F.array_repeat(F.lit(0), w), codes)
    steps = F.transform(
        F.zip_with(codes, F.slice(gone_by, F.lit(1), F.length(candidate)), lambda come, go: F.struct(
            come.alias("come"), go.alias("go"))),
        lambda x, i: F.struct(x["come"].alias("come"), x["go"].alias("go"), i.alias("i")))
    zero = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("total"), F.array().cast(_SPAN).alias("spans"))

    def moved(acc: Column, x: Column) -> Column:
        came = F.element_at(acc["counts"], x["come"])
        gone = F.element_at(acc["counts"], F.greatest(x["go"], F.lit(1)))
        changed = x["come"] != x["go"]
        total = acc["total"] + F.when(
            changed,
            F.element_at(f, came + 2) - F.element_at(f, came + 1)
            + F.when(x["go"] > 0, F.element_at(f, gone) - F.element_at(f, gone + 1)).otherwise(0),
        ).otherwise(0)
        counts = F.transform(acc["counts"], lambda v, k: v + F.when(
            changed, (k + 1 == x["come"]).cast("int") - (k + 1 == x["go"]).cast("int")).otherwise(0))
        return F.struct(counts.alias("counts"), total.alias("total"),
                        _joined(acc["spans"], x["i"], total, w, most).alias("spans"))

    return F.aggregate(steps, zero, moved, lambda acc: acc["spans"])


def _joined(spans: Column, i: Column, total: Column, w: int, most: int) -> Column:
    """Add the window that ends at character i, joined to the last span if they overlap."""
    own = F.struct((i - w + 1).alias("start"), (i + 1).alias("end"))
    last = F.element_at(spans, -1)
    longer = F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(
        F.struct(last["start"].alias("start"), own["end"].alias("end"))))
    return (F.when((i < w - 1) | (total > most), spans)
            .when(F.size(spans) == 0, F.array(own))
            .when(last["end"] >= own["start"], longer)
            .otherwise(F.concat(spans, F.array(own))))


def _wanted(kind: CharacterClass, allowed: Sequence[str]):
    def test(x: Column) -> Column:
        ok = F.lit(True)
        for need in kind.needs:
            ok &= x["m"].rlike(need)
        for rule in allowed:
            ok &= ~x["m"].rlike(rule)
        return ok

    return test


def _spread(kind: CharacterClass):
    """Entropy spans of a candidate, as offsets in the text."""
    return lambda x: F.transform(entropy_spans(x["m"], kind), lambda s: F.struct(
        (s["start"] + x["s"]["start"]).alias("start"), (s["end"] + x["s"]["start"]).alias("end")))


def find_secrets(rows: DataFrame, classes: Sequence[CharacterClass] = CLASSES,
                 allowed: Sequence[str] = ALLOWED, id_col: str = "doc_id",
                 text_col: str = "text", keep_text: bool = False,
                 carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: the id, ``base`` and ``found``, arrays of (start, rank, kind, end).

    ``base`` has the spans of the fixed patterns (``assign`` with a value of six characters or
    more, ``access``, ``hex``), ``found`` these and the spans of high entropy of each class of
    characters. A candidate string that an allow-list pattern matches gives no entropy span;
    spans of fixed patterns always stay. Both are ordered by start, then by kind as listed.

    A null or empty text has no spans. Null ids, equal ids and repeated rows are searched like
    any other row; an empty table gives an empty one; other columns are left out, but for the
    text with ``keep_text`` and those in ``carry``.
    """
    known = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)]
    patterns = known + [(c.name, c.pattern) for c in classes]
    step = pick(rows, id_col, text_col, *carry).select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *carry)
    step = step.select("id", "text", *carry, *[
        _found(F.col("text"), p).alias(f"m{k}") for k, (_, p) in enumerate(patterns)])
    step = step.select("id", "text", *carry, *[c for k, (_, p) in enumerate(patterns) for c in (
        F.col(f"m{k}"), _placed(F.col("text"), F.col(f"m{k}"), p).alias(f"s{k}"))])

    def listed(k: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(k).alias("rank"),
            F.lit(patterns[k][0]).alias("kind"), s["end"].alias("end")))

    long_enough = F.filter(
        F.arrays_zip(F.col("s0").alias("s"), F.col("m0").alias("m")),
        lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= MIN_VALUE)
    base = [listed(0, F.transform(long_enough, lambda x: x["s"])),
            listed(1, F.col("s1")), listed(2, F.col("s2"))]
    more = []
    for k, kind in enumerate(classes, start=len(known)):
        pairs = F.filter(F.arrays_zip(F.col(f"s{k}").alias("s"), F.col(f"m{k}").alias("m")),
                         _wanted(kind, allowed))
        more.append(listed(k, F.flatten(F.transform(pairs, _spread(kind)))))
    kept = ["id", *(["text"] if keep_text else []), *carry]
    return step.select(*kept, F.sort_array(F.concat(*base)).alias("base"),
                       *[m.alias(f"e{k}") for k, m in enumerate(more)]) \
        .select(F.col("id").alias(id_col), *kept[1:], "base",
                F.sort_array(F.concat("base", *[f"e{k}" for k in range(len(more))])).alias("found"))


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or group of spans that overlap, replaced by a mark."""
    merged = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["parts"]).otherwise(F.concat(
                acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                      F.lit(mark)))).alias("parts")),
        lambda acc: F.concat(F.array_join(acc["parts"], ""),
                             F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(merged)
