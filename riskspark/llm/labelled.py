"""Training rows for the classifiers: a bounded sample of the labelled documents outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Every row whose crc32 of the id as text is 0 modulo `folds`; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text, label (int) of at most `limit` labelled documents, chosen by hash of the id; of a repeated id the text with the smallest hash."""
    wanted = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    wanted = wanted.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    wanted = wanted.groupBy("doc_id").agg(F.max("label").alias("label"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(wanted), "doc_id")  # at most `limit` rows of two numbers
    least = found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("t"), F.max("label").alias("label"))
    return least.select("doc_id", F.col("t.text").alias("text"), "label")
