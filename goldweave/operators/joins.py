"""Join a side that may have hot keys to one with a row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "_key_hash"


def join_unique(rows: DataFrame, unique: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join ``rows`` to ``unique``, which has been aggregated by ``keys``.

    At run time Spark splits a hot partition of a join only if both inputs come
    straight from a shuffle made for that join. An aggregated side is already
    partitioned by the keys and gets none, so a hot key of ``rows`` would stay
    in one task. With a hash of the keys as one more join column it is shuffled
    again: one row per key, against rows that can then be split.
    """
    spread = F.xxhash64(*keys)
    left = rows.withColumn(_SPREAD, spread)
    right = unique.withColumn(_SPREAD, spread)
    return left.join(right, [*keys, _SPREAD], how).drop(_SPREAD)
