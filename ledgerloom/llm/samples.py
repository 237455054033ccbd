"""The bounded sample of labelled documents that a model is fitted on, and the held-out rows it never sees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fold kept out of every fit: crc32 of the id as text, modulo 4, is 2. False for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``size`` labelled documents outside the held-out fold.

    They are chosen by a hash of their id. Null ids and labels are left out; of
    several labels of a document the smallest counts, of several texts the one
    with the smallest hash; a null text counts if there is no other. Only the
    chosen ids, at most ``size`` of them, are broadcast.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Hashes are reduced in the map tasks, so an id of many rows moves no more texts than there are tasks.
    least = F.min_by(F.struct("text", "label"), F.struct(F.col("text").isNull(), F.xxhash64("text"), "text"))
    found = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(least.alias("row"))
    return found.select("doc_id", "row.text", "row.label")
