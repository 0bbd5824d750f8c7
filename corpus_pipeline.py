"""A corpus from raw documents to packed training sequences, a stage at a time.

Each stage is one operator over all rows that the stage before it kept. Its result is
written as Parquet and read back for the next one.
"""

from itertools import count

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.exact_dedup import drop_copies
from barloom.llm.near_dedup import drop_near_copies
from barloom.llm.packing import pack
from barloom.llm.quality import keep_good
from barloom.llm.secrets import mask_secrets
from barloom.operators.keyed import landed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; cutoffs come from the labels."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by links the one with the smallest id stays."""
    return drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; n_chars follows the change. All documents stay."""
    taken = {name.lower() for name in docs.columns}
    before = next(name for k in count() if (name := f"_chars_before_{k}") not in taken)
    masked = mask_secrets(docs.withColumn(before, F.length("text")))
    n_chars = F.coalesce(F.col("n_chars") + F.length("text") - F.col(before), F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).drop(before)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Neither the network of the secret scan nor a tokenizer can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
