"""The corpus pipeline: documents go through the stages in order, each written as Parquet and read again.

Toxic documents go; one document of each group of near duplicates stays; documents that hold test items go; secrets
are masked; what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featurelake.llm import decontaminate, jaccard, packing, secrets
from featurelake.llm import toxicity as toxic
from featurelake.llm.common import shared_folder, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled ones, does not reject."""
    return toxic.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that links connect."""
    return jaccard.clean(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a test item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return packing.pack(packing.cut(docs, keep=False))


STAGES = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the ``documents`` of a folder."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for k, (name, fn) in enumerate(STAGES):
        out = fn(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}-{name}")
    return docs
