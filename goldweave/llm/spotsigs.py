"""Document fingerprints by spot signatures.

Common words are anchors; each anchor with the two content words after it is a signature of
its place. A fingerprint is the sorted set of signatures. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweave.llm.tables import pick

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "he", "in", "is",
    "it", "its", "not", "of", "on", "or", "that", "the", "this", "to", "was", "were", "which", "with",
    "au", "aux", "avec", "ce", "dans", "des", "du", "elle", "et", "il", "je", "la", "le", "les", "ou",
    "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "auf", "bei", "das", "dem", "den", "der", "die", "ein", "eine", "er", "ist", "mit", "nicht",
    "sich", "sie", "und", "von", "zu",
    "con", "del", "el", "en", "es", "lo", "los", "no", "para", "por", "se", "su", "una", "y",
)
DIGITS = 8
CHAIN = 2


def _any_of(words: Sequence[str]) -> str:
    """A pattern for the words, by first letter, so that few branches are tried per word."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(words, reverse=True):
        by_first.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{k}(?:{'|'.join(rest)})" for k, rest in sorted(by_first.items()))


def with_signatures(rows: DataFrame, columns: dict[str, str],
                    anchors: Sequence[str] = ANCHORS) -> DataFrame:
    """The rows with the sorted distinct signatures of text columns; ``columns``: new by text.

    Words are runs of letters and digits in lower case. Every content word carries the anchors
    right before it; the last of these, the word and the next content word are a signature, kept
    as hexadecimal digits of a hash. A text in which no anchor is followed by a content word
    uses all its words as if anchored.

    Each step is a projection of its own, as Spark would otherwise evaluate the longer ones
    once for each use.
    """
    # One anchor at a time: a repeated group would go as deep as the longest run of anchors.
    anchor = rf"(?<![^ ])({_any_of(anchors)}) "

    def cut(text: str) -> Column:
        plain = F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "))
        tied = F.regexp_replace(plain, anchor, "$1_")
        return F.filter(F.split(tied, " "), lambda g: g != "")

    def word(g: Column) -> Column:
        return F.substring_index(g, "_", -1)

    def paired(g: str) -> Column:
        own = F.col(g)
        return F.zip_with(own, F.slice(own, 2, F.size(own)), lambda x, y: F.struct(
            F.contains(x, F.lit("_")).alias("spot"), F.concat_ws(
                " ", F.translate(F.substring_index(x, "_", -CHAIN), "_", " "),
                F.coalesce(word(y), F.lit(""))).alias("sig")))

    def signed(g: str) -> Column:
        # The count stays outside of the lambda, or it would be taken for each element.
        spots = F.when(F.col(f"n_{g}") > 0, F.filter(g, lambda x: x["spot"])).otherwise(F.col(g))
        return F.sort_array(F.array_distinct(F.transform(
            spots, lambda x: F.substring(F.md5(x["sig"]), 1, DIGITS))))

    kept = [c for c in rows.columns]
    step = rows.select(*kept, *[cut(t).alias(n) for n, t in columns.items()])
    step = step.select(*kept, *[paired(n).alias(n) for n in columns])
    step = step.select(*kept, *columns, *[
        F.size(F.filter(n, lambda x: x["spot"])).alias(f"n_{n}") for n in columns])
    return step.select(*kept, *[signed(n).alias(n) for n in columns])


def fingerprint(found: Column) -> Column:
    """Signatures as one string; it can be cut up again, since all have the same length."""
    return F.array_join(found, "")


def length_partition(n: Column, threshold: float) -> Column:
    """Partition of a set of n signatures.

    Sets that are as alike as the threshold differ in size by a factor of at most its inverse,
    so they are in the same partition or in neighbouring ones.
    """
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / -math.log(threshold)).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard of two sets; 0 without a look at them if their sizes rule out ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (F.when(a == b, F.lit(1.0))
            .when((small == 0) | (small < least * large), F.lit(0.0))
            .otherwise(shared / (small + large - shared)))


def similar_pairs(sets: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                  set_col: str = "signatures") -> DataFrame:
    """Pairs of different sets that are at least as alike as the threshold, and who has each set.

    Returns ``(id, class_id)`` rows joined to pairs ``(class_a, class_b, similarity)``: one row
    per member and partner class, so copies are not expanded. Equal sets are first brought
    together. Two sets as alike as t share one of the first n - ceil(t n) + 1 signatures of each
    in the order of rarity, and only sets of the same or neighbouring length partitions meet.
    """
    spark_rows = pick(sets, id_col, set_col).select(
        F.col(id_col).alias("id"), F.col(set_col).alias("s"))
    members = spark_rows.where(F.size("s") > 0).withColumn("k", F.md5(F.array_join("s", "")))
    classes = members.groupBy("k").agg(F.min("id").alias("class"), F.first("s").alias("s"))
    frequency = classes.select(F.explode("s").alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    listed = classes.select("class", F.explode("s").alias("g")).join(frequency, "g")
    rare = listed.groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("df", "g"))).alias("o")).select("class", "o")
    prefix = rare.select(
        "class", F.size("o").alias("n"),
        F.explode(F.slice("o", F.lit(1), F.size("o") - F.ceil(threshold * F.size("o")).cast("int") + 1))
        .alias("x")).select("class", "n", F.col("x.g").alias("g"),
                            length_partition(F.col("n"), threshold).alias("p"))
    left = prefix.select(F.col("class").alias("a"), "g", F.explode(
        F.array(F.col("p"), F.col("p") + 1)).alias("p"), F.col("n").alias("na"), F.col("p").alias("pa"))
    right = prefix.select(F.col("class").alias("b"), "g", "p", F.col("n").alias("nb"))
    fits = (F.least("na", "nb") >= threshold * F.greatest("na", "nb")) & (
        (F.col("pa") < F.col("p")) | (F.col("a") < F.col("b")))
    met = left.join(right, ["g", "p"]).where(fits).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sa = classes.select(F.col("class").alias("a"), F.col("s").alias("sa"))
    sb = classes.select(F.col("class").alias("b"), F.col("s").alias("sb"))
    score = likeness(F.col("sa"), F.col("sb"), threshold)
    pairs = met.join(sa, "a").join(sb, "b").select("a", "b", score.alias("similarity")) \
        .where(F.col("similarity") >= threshold)
    both = pairs.select("a", "b", "similarity").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    member = members.join(classes.select("k", "class"), "k").select("id", "class")
    return member.join(both, member["class"] == both["a"], "left").select(
        F.col("id").alias(id_col), F.col("class").alias("class_id"), F.col("b").alias("like_class"),
        "similarity")


def next_rows(rows: DataFrame, id_col: str, columns: Sequence[str], per_bucket: int = 4_000,
              most_buckets: int = 4096) -> DataFrame:
    """The rows with a column ``next``: a struct of ``columns`` of the next row by descending id.

    After the last row comes the first. Rows with equal ids are in the order of the other
    columns given, null ids come last. Ids are dealt to buckets between quantiles (a bounded
    list of numbers), rows are ordered within their bucket, and the last row of a bucket takes
    the first row of the next filled bucket; those are one row per bucket.
    """
    counted = rows.agg(F.count("*").alias("n")).first()["n"]
    wanted = max(1, min(most_buckets, counted // per_bucket + 1))
    bounds = rows.agg(F.percentile_approx(
        id_col, [k / wanted for k in range(1, wanted)] or [0.5], 10_000).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds)) if wanted > 1 else []
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[k:k + step] for k in range(0, len(bounds), step)] or [[]]

    def numbers(values: Sequence[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values]).cast("array<bigint>")

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col(id_col)))

    coarse = F.greatest(passed(numbers([g[0] for g in groups if g])) - 1, F.lit(0))
    fine = passed(F.element_at(F.array(*[numbers(g) for g in groups]), coarse + 1))
    bucket = F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(coarse * step + fine)
    order = [F.col(id_col).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in columns]]
    value = F.struct(*columns)
    dealt = rows.withColumn("bucket", bucket)
    firsts = dealt.groupBy("bucket").agg(F.min_by(
        value, F.struct((-F.col(id_col)).alias("i"), *columns)).alias("first"))
    # One row per bucket: the filled bucket below each, the top one after the lowest.
    by_bucket = Window.orderBy(F.col("bucket").desc())
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = firsts.select("bucket", F.coalesce(
        F.lead("first").over(by_bucket), F.first("first").over(whole)).alias("after"))
    # At most most_buckets + 2 rows.
    joined = dealt.withColumn("inner", F.lead(value).over(Window.partitionBy("bucket").orderBy(*order)))
    return joined.join(links, "bucket").withColumn("next", F.coalesce("inner", "after")) \
        .drop("bucket", "inner", "after")


def edited(text: Column, other: Column) -> Column:
    """The text with its last half replaced by as many first characters of another."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def fingerprint_documents(rows: DataFrame, anchors: Sequence[str] = ANCHORS,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``text`` and ``signatures`` of every row.

    A null or empty text has no signatures, and its fingerprint is empty. Null ids, equal ids
    and repeated rows are fingerprinted like any other row; an empty table gives an empty one;
    other columns are left out.
    """
    picked = pick(rows, id_col, text_col).select(
        F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return with_signatures(picked, {"signatures": "text"}, anchors)


def compare_edited(rows: DataFrame, anchors: Sequence[str] = ANCHORS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The id must be an integer. ``near_edited`` and ``near_next`` are the Jaccard of the
    signature sets; an empty set is like an empty set only.
    """
    picked = pick(rows, id_col, text_col).select(
        F.col(id_col).cast("long").alias(id_col),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    pairs = next_rows(picked, id_col, ["text"]).select(
        id_col, "text", F.col("next.text").alias("other"))
    made = pairs.withColumn("edited", edited(F.col("text"), F.col("other")))
    texts = made.select(id_col, "text", "other", "edited", F.length("text").cast("long").alias("n_chars"),
                        F.sha2("edited", 256).alias("edited_sha256"))
    signed = with_signatures(texts, {"own": "text", "changed": "edited", "following": "other"}, anchors)
    return signed.select(
        id_col, "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))
