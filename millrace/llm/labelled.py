"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_bucket


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    held_out: int,
    per_class: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, y, weight) of at most ``per_class`` documents of each label.

    Only labels of ids whose crc32 modulo ``modulus`` is not ``held_out`` are
    used; of those, the ones with the smallest hashes. An id with both labels
    counts as 1. The chosen ids are at most twice ``per_class``; documents join
    to them. ``weight`` is how many known documents of its label each one stands
    for, so that a rare label does not seem frequent.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & (label_bucket(F.col("doc_id"), modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("y"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    stands_for = {y: max(n / per_class, 1.0) for y, n in counts.items()}
    chosen = [
        known.where(F.col("y") == y)
        .orderBy("order", "doc_id")
        .limit(per_class)
        .select("doc_id", "y", F.lit(stands_for.get(y, 1.0)).alias("weight"))
        for y in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "id")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most 2 * per_class rows of three numbers
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "y", "weight")
