"""From raw documents to packed training sequences: five stages over the corpus operators.

Every stage gets the rows its predecessor kept and returns the columns of ``documents``; the last one returns
the pieces of the packed sequences. Rows without a text stay to the end and become one closing id each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returns_analytics.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from returns_analytics.llm.storage import Scratch

#: Words of a shingle and percent of similarity from which documents are near copies.
SHINGLE, PERCENT = 5, 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go; it learns from the labels of documents still there."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out; documents that were nothing else go."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in kept.columns else kept


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return jaccard.keep_first(docs, SHINGLE, PERCENT)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontamination", remove_benchmark_passages),
    ("packing", pack),
]

#: The model of the first stage and the token ids of the last one cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each result stored before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
