"""Reading the inputs of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def pick(rows: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact spelling, the first of each if several have one name."""
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return plain.select(*[F.col(f"c{rows.columns.index(n)}").alias(n) for n in names])


def texts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id`` and ``text``; a null text counts as empty, other columns are left out."""
    picked = pick(rows, *dict.fromkeys([id_col, text_col]))
    return picked.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def id_type(rows: DataFrame, id_col: str) -> T.DataType:
    return pick(rows, id_col).schema[0].dataType


def schema(first: T.DataType, rest: str, name: str = "id") -> T.StructType:
    """A schema with a leading id column of the given type."""
    return T.StructType([T.StructField(name, first), *T.StructType.fromDDL(rest).fields])
