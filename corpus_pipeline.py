"""A corpus pipeline: toxicity, line dedup, near dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and gives the documents that the next one
works on; the last gives their tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import bpe_encode
from millrace.llm.common import written
from millrace.llm.line_dedup import line_dedup
from millrace.llm.mixing import mixed_documents
from millrace.llm.simhash import one_of_each
from millrace.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines and passages; ``n_chars`` follows the text."""
    out = line_dedup(docs, passages=True).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe_encode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixing),
    ("BPE tokens", tokens),
]

#: The first stage is a trained model and others hash in ways SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
