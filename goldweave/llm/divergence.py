"""How far the sources of a language differ in their use of words.

Every group (a language's source) gives each kept term a price, which goes up in steps with the
term's count there. The indicator columns of (group, count level) over a block of terms, times
their transpose, hold for each pair of groups the table of how many terms stand at which two
levels; a table times the differences of its levels' prices is the pair's divergence over the
block. The products are taken in blocks of terms and of groups, so no task holds a whole
language, and they are exact: entries of the tables are small whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweave.llm.chunks import slices
from goldweave.llm.tables import pick
from goldweave.operators.joins import join_unique
from goldweave.session import staged

SLICE_BYTES = 8 << 20
MIN_DOCUMENTS = 30
SCALE = 1_000_000_000
SMOOTH = 5
# Terms (by a hash) and groups of one task; terms and indicator columns of one product.
TERM_BLOCK = 512
GROUP_BLOCK = 64
PRODUCT_TERMS = 128
PRODUCT_COLUMNS = 1024

# A term is a run of letters A to Z and of everything beyond ASCII; in UTF-8 both are bytes.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(rows: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and rows they are in, of each term of a group.

    A group also has one row without a term. Terms of a slice are added up before they are sent.
    """
    picked = pick(rows, *dict.fromkeys([text_col, lang_col, source_col]))
    plain = picked.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
        for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])

    def run(batches):
        for batch in batches:
            for start, column in slices(batch.column(0).cast(pa.binary()), SLICE_BYTES):
                groups = pa.StructArray.from_arrays(
                    [batch.column(c).slice(start, len(column)) for c in (1, 2)], names=["lang", "source"])
                yield _counted(column, groups)

    counts = plain.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _counted(column: pa.Array, groups: pa.StructArray) -> pa.RecordBatch:
    words = [t.translate(_TERM_BYTES).split() for t in column.to_pylist()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    terms, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    names = groups.field(0), groups.field(1)
    group_of = _codes(*names)
    first = np.unique(group_of, return_index=True)[1]
    group_of = np.searchsorted(group_of[first], group_of)
    width = max(len(terms), 1)
    per_row, n = np.unique(np.repeat(np.arange(len(words)), sizes) * width + codes, return_counts=True)
    keys, at = np.unique(group_of[per_row // width] * width + per_row % width, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, n)
    rows = np.concatenate([first[keys // width], first])
    return pa.RecordBatch.from_arrays([
        names[0].take(pa.array(rows)), names[1].take(pa.array(rows)),
        pa.concat_arrays([terms.take(pa.array(keys % width)), pa.nulls(len(first), pa.binary())]).cast(pa.string()),
        pa.array(np.append(total, np.zeros(len(first), np.int64))),
        pa.array(np.append(np.bincount(at, minlength=len(keys)), np.zeros(len(first), np.int64))),
    ], names=["lang", "source", "term", "n", "docs"])


def _codes(lang: pa.Array, source: pa.Array) -> np.ndarray:
    """A number for each pair of values, equal for equal pairs."""
    a, b = lang.dictionary_encode(), source.dictionary_encode()
    return a.indices.to_numpy().astype(np.int64) * max(len(b.dictionary), 1) + b.indices.to_numpy()


def price(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (n + 5) / (total + 5 * terms)) in whole numbers; null without terms."""
    over = ((n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(31,0)")
    under = (total.cast("decimal(20,0)") + terms.cast("decimal(20,0)") * SMOOTH).cast("decimal(21,0)")
    quotient = F.call_function("div", over, F.when(terms > 0, under))
    return (quotient + 1).cast("long")


def one_hot(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indicator columns of (group, level): ``codes`` holds each term's level per group."""
    offsets = np.cumsum(sizes) - sizes
    hot = np.zeros((len(codes), int(sizes.sum())), np.float32)
    hot[np.arange(len(codes))[:, None], codes + offsets] = 1
    return hot


def _levels(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each column: the level of each row, the number of levels, and all levels' prices."""
    found = [np.unique(prices[:, g], return_inverse=True) for g in range(prices.shape[1])]
    codes = np.stack([c for _, c in found], axis=1)
    return codes, np.array([len(p) for p, _ in found]), np.concatenate([p for p, _ in found])


def _panels(sizes: np.ndarray) -> list[slice]:
    """Consecutive groups with at most PRODUCT_COLUMNS levels together, or one group."""
    out, start, held = [], 0, 0
    for g, n in enumerate(sizes.tolist()):
        if held and held + n > PRODUCT_COLUMNS:
            out.append(slice(start, g))
            start, held = g, 0
        held += n
    return [*out, slice(start, len(sizes))]


def divergences(prices: np.ndarray, left: int, same: bool) -> np.ndarray:
    """Sum over terms of the difference in price, for groups of the left and of the right.

    ``prices`` has a row per term and a column per group, the first ``left`` columns being the
    left ones; with ``same`` all columns are both.
    """
    right = 0 if same else left
    out = np.zeros((left, prices.shape[1] - right), np.int64)
    # Terms of like prices share levels, which keeps the tables small.
    prices = prices[np.argsort(prices.sum(axis=1), kind="stable")]
    for low in range(0, len(prices), PRODUCT_TERMS):
        codes, sizes, values = _levels(prices[low:low + PRODUCT_TERMS])
        ends = np.cumsum(sizes)

        def panel(s: slice, base: int) -> tuple[slice, np.ndarray, np.ndarray, np.ndarray]:
            g = slice(s.start + base, s.stop + base)
            own = values[ends[g.start] - sizes[g.start]:ends[g.stop - 1]]
            return s, one_hot(codes[:, g], sizes[g]), own, np.cumsum(sizes[g]) - sizes[g]

        rows = [panel(s, 0) for s in _panels(sizes[:left])]
        columns = rows if same else [panel(s, right) for s in _panels(sizes[right:])]
        for i, (a, hot_a, price_a, start_a) in enumerate(rows):
            for b, hot_b, price_b, start_b in columns[i if same else 0:]:
                tables = (hot_a.T @ hot_b).astype(np.int64)
                tables *= np.abs(price_a[:, None] - price_b[None, :])
                out[a, b] += np.add.reduceat(np.add.reduceat(tables, start_a, axis=0), start_b, axis=1)
    return out


def _product(key: tuple[pa.Scalar, ...], rows: pa.Table, group_block: int) -> pa.Table:
    """Divergences over one block of terms between two blocks of groups, ``one`` below ``other``."""
    lang, _, low, high = (k.as_py() for k in key)
    number = rows.column("number").to_numpy()
    term = rows.column("term")
    cost = rows.column("price").fill_null(0).to_numpy()
    is_head = term.is_null().to_numpy()
    heads = np.flatnonzero(is_head)
    heads = heads[np.argsort(number[heads])]
    groups = number[heads]
    left = int(np.searchsorted(groups, (low + 1) * group_block))
    coded = term.filter(pa.array(~is_head)).combine_chunks().dictionary_encode()
    matrix = np.repeat(cost[heads][None, :], len(coded.dictionary), axis=0)
    matrix[coded.indices.to_numpy(), np.searchsorted(groups, number[~is_head])] = cost[~is_head]
    same = low == high
    value = divergences(matrix, left, same)
    i, j = np.triu_indices(left, 1) if same else map(np.ravel, np.indices(value.shape))
    other = groups if same else groups[left:]
    return pa.table({
        "lang": pa.array([lang] * len(i), pa.string()), "one": groups[i], "other": other[j],
        "value": value[i, j], "seen": np.full(len(i), len(matrix))})


def _pairs(entries: DataFrame, groups: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """``lang, source, item, value`` for each two sources of a language, both ways."""
    blocks = groups.withColumns({
        "group_block": F.expr(f"number div {group_block}"),
        "group_blocks": F.expr(f"(members - 1) div {group_block} + 1"),
        "term_blocks": F.expr(f"greatest(1, (terms + {term_block - 1}) div {term_block})")})
    partners = F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)).alias("partner")
    shape = ("lang", "block", "number", "term", "price", "group_block", "group_blocks")
    heads = blocks.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"), F.col("none").alias("price")).select(*shape)
    cells = join_unique(
        entries.select("lang", "source", "term", "price"),
        blocks.select("lang", "source", "number", "group_block", "group_blocks", "term_blocks"),
        ["lang", "source"], "inner",
    ).withColumn("block", F.pmod(F.xxhash64("term"), F.col("term_blocks"))).select(*shape)
    dealt = heads.unionByName(cells).select("lang", "block", "number", "term", "price", "group_block", partners)
    dealt = dealt.select(
        "lang", "block", F.least("group_block", "partner").alias("low"),
        F.greatest("group_block", "partner").alias("high"), "number", "term", "price")

    def product(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _product(key, rows, group_block)

    sums = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
        product, "lang string, one long, other long, value long, seen long"
    ).groupBy("lang", "one", "other").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))

    def named(side: str) -> DataFrame:
        return groups.select(
            "lang", F.col("number").alias(side), F.col("source").alias(f"{side}_source"),
            F.col("none").alias(f"{side}_none"), F.col("terms").alias(f"{side}_terms"))

    whole = sums.join(named("one"), ["lang", "one"]).join(named("other"), ["lang", "other"])
    # Kept terms that neither group has stand at both groups' lowest level.
    rest = (F.col("one_terms") - F.col("seen")) * F.abs(F.col("one_none") - F.col("other_none"))
    whole = whole.withColumn("value", F.col("value") + F.coalesce(rest, F.lit(0)))
    ways = F.explode(F.array(
        F.struct(F.col("one_source").alias("source"), F.col("other_source").alias("item")),
        F.struct(F.col("other_source").alias("source"), F.col("one_source").alias("item"))))
    return whole.select("lang", "value", ways.alias("way")).select("lang", "way.source", "way.item", "value")


def audit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_documents: int = MIN_DOCUMENTS, top: int = 50, group_block: int = GROUP_BLOCK,
          term_block: int = TERM_BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language stands out.

    Part ``pair``: every other source of the language, by its divergence, all ranks. Part
    ``term``: the ``top`` terms which the source prices most above its language, of those it has.
    A task takes about ``term_block`` terms of twice ``group_block`` sources at most.
    Ranks start at 1 per group and part; equal values are in order of ``item`` by its bytes.

    A null text, language or source counts as empty. Documents are rows, so repeated ones count
    again. A group whose texts have no kept term is compared like any other; in a language without
    kept terms all divergences are 0. An empty table gives an empty one; other columns are left
    out, also such as are named like columns of the result.
    """
    counts = staged(term_counts(rows, text_col, lang_col, source_col), "term-counts")
    words = counts.where(F.col("term").isNotNull())
    kept = words.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")
    ).where(F.col("docs") >= min_documents).drop("docs")
    entries = staged(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    langs = entries.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.select("lang", "source").distinct() \
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(
            0, ["total", "terms", "lang_total"])
    by_lang = Window.partitionBy("lang")
    groups = staged(groups.withColumns({
        "number": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"),
        "members": F.count("*").over(by_lang),
        "none": price(F.lit(0), F.col("total"), F.col("terms")),
    }), "term-groups")
    sized = join_unique(
        entries, groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"], "inner")
    priced = sized.withColumns({
        "price": price(F.col("n"), F.col("total"), F.col("terms")),
        "usual": price(F.col("lang_n"), F.col("lang_total"), F.col("terms"))})
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = priced.where(F.col("price") > F.col("usual")).select(
        "lang", "source", F.col("term").alias("item"), (F.col("price") - F.col("usual")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    pairs = _pairs(priced, groups, group_block, term_block).withColumn("rank", F.row_number().over(by_value))
    columns = ("item", "value", "rank")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), *columns).unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), *columns))
