"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm import mixing, near_dup, ngram_rules, packing, quality
from residua.session import bound_arrow_batches, staged, table, unstage

#: The near-duplicate stage's shingle words and similarity.
WORDS, PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good.

    Every row is judged by its whole text alone: null and empty texts get the model's bias, repeated rows
    the same verdict, and a score that ties with the threshold stays. Null ids are judged as others are.
    Other columns go through as they are, whatever their names; an empty table stays empty.
    """
    bound_arrow_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score(F.col("text"), model) >= quality.THRESHOLD)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the plain rules nor the likelihood ratio rejects.

    Null and empty texts have no words and go; texts of any length are judged whole; repeated rows get the
    same verdict, and a ratio that ties with the threshold stays. A null id is never trusted. Columns of any
    name go through as they are; an empty table stays empty.
    """
    ratios = ngram_rules.log_ratios(docs, ngram_rules.trusted_ids(table(spark, sf_dir, "labels")))
    return ngram_rules.judge(docs, ratios).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id.

    Rows that repeat an id are one document, of which the row that sorts first stays. Rows without an id
    are one document a text, and stay unless they equal a document that has one; null texts equal nothing
    that has an id. Null and empty texts have no copies. Texts of any length are read whole. Columns of
    any name go through as they are, and an empty table stays empty.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(doc_id.alias("id"), F.sha2(text, 256).alias("digest"), row.alias("row"))
    found = near_dup.near_duplicates(docs.select(doc_id.alias("doc_id"), text.alias("text")), WORDS, PERCENT)
    kept = found.filter("kept").select(F.col("doc_id").alias("id")).distinct()
    # A row with a map can't be compared, but its JSON can.
    order = F.to_json("row") if "map<" in docs.schema.simpleString() else F.col("row")
    first = F.min_by("row", order).alias("row")
    named = rows.join(kept.hint("merge"), "id", "left_semi").groupBy("id").agg(first)
    out = named.select("row.*")
    nameless = rows.filter(F.col("id").isNull())
    if not nameless.isEmpty():
        known = rows.filter(F.col("id").isNotNull()).select("digest").distinct()
        alone = nameless.groupBy("digest").agg(first).join(known.hint("merge"), "digest", "left_anti")
        out = out.unionByName(alone.select("row.*"))
    return out


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, put into the order of the mixture; the files keep it.

    A null source is a source of its own, null and empty texts take one character's room, a text longer than
    a block takes the slots that its start falls into, and rows that tie in id and text stand together.
    Columns of any name go through as they are; an empty table stays empty.
    """
    return mixing.in_order(docs, max_sources=None)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents are packed into.

    A null or empty text is one end-of-document token; a long text is cut into as many sequences as it needs;
    repeated rows and null ids are packed row by row, in the order they come in; an empty table gives no pieces.
    Other columns are not read.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: The classifier's training can't be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before is not None:
            unstage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
