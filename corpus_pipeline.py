"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the first four return the
columns of documents.  Language ID drops documents whose language cannot be told, the Jaccard join keeps the
smallest id of each group of near copies, suffix dedup and PII rewrite texts and drop no document, and packing
returns pieces.  Models are learned from the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import common, jaccard_join, language_id, packing, pii, suffix_dedup


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs.where(common.fold_bucket("doc_id", 4) != 2))
    return language_id.known_language(docs, model)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(suffix_dedup.remove_repeats(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(pii.mask_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("language", tell_language), ("near_copies", join_near_copies), ("repeats", drop_repeats), ("personal_data", mask_personal_data), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
