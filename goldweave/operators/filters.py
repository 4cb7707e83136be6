"""Leave out most rows that a join will not find, before they are shuffled for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words of the bitmap, 64 bits each. A broadcast holds at most so many rows of two numbers,
# some 32 MB, whatever the number of keys.
WORDS = 1 << 20


def key_filter(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """The rows whose ``keys`` are among those of ``wanted``, and a few others.

    The hashes of the wanted keys are marked in a bitmap, which is broadcast as its words that
    have a mark: its size is bound by ``words``, not by ``wanted``. A row stays if the place of
    its hash is marked; of the rest about one in ``64 * words / keys`` stays by chance, so with
    very many keys the filter leaves more through but costs no more. Follow it with the join.
    """
    bits = 64 * words
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    marked = wanted.select(place.alias("_place")).groupBy(F.expr("_place div 64").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_place % 64 as int))")).alias("_bits"))
    placed = rows.withColumn("_place", place).withColumn("_word", F.expr("_place div 64"))
    hit = F.expr("getbit(_bits, cast(_place % 64 as int)) = 1")
    return placed.join(F.broadcast(marked), "_word").where(hit).select(*rows.columns)
