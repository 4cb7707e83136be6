"""From documents to packed training sequences, in four stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet in
the shared folder and gives it to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.llm import jaccard, packing, quality, secrets
from goldweave.llm.tables import DOCUMENT_COLUMNS, pick, read
from goldweave.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; each distinct text under an id is judged by itself."""
    docs = _identified(docs)
    kept = quality.quality(docs, id_col="row").where("kept")
    return _semi(docs, kept.select("row")).drop("row")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id.

    Null ids come last; among texts with that id, the hash of the text decides.
    """
    docs = _identified(docs)
    first = jaccard.near_duplicates(docs, id_col="row").where(F.col("row") == F.col("class_id"))
    return _semi(docs, first.select("row")).dropDuplicates(["row"]).drop("row")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and their lengths counted anew."""
    docs = pick(docs, *DOCUMENT_COLUMNS)
    found = secrets.find_secrets(docs, keep_text=True, carry=("lang", "source", "n_chars"))
    text = secrets.masked(F.col("text"), F.col("found"))
    clean = found.withColumn("masked", text)
    hit = F.size("found") > 0
    return clean.select(
        "doc_id", F.col("masked").alias("text"), "lang", "source",
        F.when(hit, F.length("masked").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    return packing.digest(packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1))


def _identified(docs: DataFrame) -> DataFrame:
    """The documents with ``row``, which is equal for repeats of an id with its text only.

    It is never null and sorts by id, null ids last.
    """
    return pick(docs, *DOCUMENT_COLUMNS).withColumn("row", F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id",
        F.col("text").isNull().alias("no_text"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("hash")))


def _semi(docs: DataFrame, rows: DataFrame) -> DataFrame:
    chosen = rows.select(F.col("row").alias("chosen")).distinct()
    return docs.join(chosen, docs["row"] == chosen["chosen"], "left_semi")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard),
    ("secret scans", secret_scans),
    ("packing", pack_sequences),
]

# Tokens and near duplicates are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
