"""Bounded samples of labelled documents, for fitting small models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that a model is fitted on, at most.
PER_CLASS = 2000
#: Characters that one of them may have, and all of them together; a text that doesn't fit is skipped.
MAX_TEXT, MAX_CHARS = 1_000_000, 60_000_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo folds; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, kept_back: int) -> Column:
    """Whether the row is never learned from; false for a null doc_id, which is never learned from either."""
    return F.coalesce(fold(doc_id, folds) == kept_back, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, kept_back: int, per_class: int = PER_CLASS
) -> list[tuple[str, int]]:
    """Texts and 0/1 labels of at most per_class documents a class, outside the fold that is kept back.

    The ids with the smallest hashes are taken, so the sample is spread over the table and the same in
    every run. The ids joined with the documents are at most 2 * per_class, which bounds the broadcast.
    An id counts once, with the larger label and the text that sorts first; null ids, labels and texts are
    left out, and so are texts over MAX_TEXT and those that the rest of MAX_CHARS has no room for, which
    says nothing about the texts after them.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.filter((fold(F.col("doc_id"), folds) != kept_back) & F.col("label").isin(0, 1))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [usable.filter(F.col("label") == k).distinct().orderBy(*order).limit(per_class) for k in (0, 1)]
    ids = picked[0].unionByName(picked[1]).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = (
        texts.filter(F.length("text") <= MAX_TEXT)
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .orderBy(*order)
    )
    out, chars = [], 0
    for row in found.toLocalIterator():
        if chars + len(row.text) <= MAX_CHARS:
            chars += len(row.text)
            out.append((row.text, row.label))
    return out
