"""Bounded samples of labelled documents for fitting the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5; fold 0 is held out of all fitting.
    A null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                  max_fold: int = FOLDS) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y, pick) of at most ``per_class`` labelled documents of
    each class outside fold 0, and the number of such labelled ids by class.

    Labels of one id that disagree count as 1 if any does; null labels and
    ids are not used.  The choice is by a hash of the id, so it does not
    depend on partitioning; ``pick`` is that hash.  Only the chosen ids (at
    most ``2 * per_class``) are broadcast to the scan of the documents."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(fold(F.col("doc_id")) != 0)
           .groupBy("doc_id").agg(F.max(F.when(F.col("y") > 0, 1).otherwise(0)).alias("y")))
    counts = {int(r["y"]): int(r["count"]) for r in lab.groupBy("y").count().collect()}
    hashed = lab.withColumn("pick", F.xxhash64("doc_id"))
    chosen = None
    for y in (0, 1):
        part = hashed.filter(F.col("y") == y).orderBy("pick", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return text.join(F.broadcast(chosen), "doc_id"), counts
