"""What both classifiers share: the held-out fold and a bounded sample of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text is divisible by five; no label of theirs is learnt. A NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows outside the held-out fold, the lowest by hashed id.

    A label counts once for its id, and so does a text: of several texts of one id the least is taken, NULL last. The chosen ids are at most
    ``most``, so they are broadcast; the other texts stay where they are.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label")).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
