"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Words and pairs of neighbouring words are hashed into buckets. Two multinomials over the buckets are
counted, one over trusted documents and one over all documents, each with one added to every bucket. A
document's score is the mean, over its n-grams, of the log of their ratio; documents below a fixed
threshold go, as do those that fail the plain rules on length and repetition.

All of it is DataFrame operations. The trusted ids are joined without a limit, by shuffle at
every size. Counts are combined before their shuffle, which so carries a row a bucket and task; the ratios, one number a bucket, come back to the driver and go into the plan as an
array; scoring shuffles nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the two multinomials.
BUCKETS = 1 << 14
#: Documents whose mean log ratio is lower are rejected.
THRESHOLD = -0.1
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
_BLANKS = " \t\n\x0b\f\r"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")


def _buckets(words: str, buckets: int) -> Column:
    """Buckets of all words and of all neighbouring pairs in the array column."""
    return F.expr(
        f"""concat(
            transform({words}, w -> int(pmod(xxhash64(w), {buckets}L))),
            transform(slice({words}, 1, greatest(size({words}) - 1, 0)),
                (w, i) -> int(pmod(xxhash64(w, get({words}, i + 1)), {buckets}L))))"""
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good."""
    good = labels.filter(F.col("quality").cast("int") == 1).select(F.col("doc_id").cast("long").alias("doc_id"))
    return good.filter(F.col("doc_id").isNotNull()).distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """ln(target / raw) of every bucket, counted over the documents with a trusted id and over all.

    trusted may be of any size; its ids are distinct. Without trusted documents all ratios are 0.
    """
    ids = trusted.select(F.col("doc_id").alias("_trusted"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), text.alias("_text"))
    rows = rows.join(ids.hint("merge"), F.col("_doc") == F.col("_trusted"), "left")
    rows = rows.select(_words(F.col("_text")).alias("_words"), "_trusted")
    each = rows.select(F.explode(_buckets("_words", buckets)).alias("bucket"), F.col("_trusted").isNotNull().alias("target"))
    counts = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("target").alias("target"))
    raw, target = [1] * buckets, [1] * buckets
    for r in counts.collect():  # a row a bucket at most
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if sum(target) == buckets:
        return [0.0] * buckets
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw, strict=True)]


def _as_array(values: list[float]) -> Column:
    """One constant of the plan, however many values."""
    return F.expr(f"cast(split('{','.join(map(repr, values))}', ',') as array<double>)")


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The rules' columns for every row of docs, and `row`, a struct of all its columns.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr.
    """
    blank, symbols = _BLANKS, "#*$%&|<>"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"))
    rows = rows.withColumn("words", _words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.select(
        "row",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", blank, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", symbols, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.expr(
            """transform(slice(words, 1, greatest(size(words) - 2, 0)),
                (w, i) -> xxhash64(w, get(words, i + 1), get(words, i + 2)))"""
        ).alias("windows"),
        _buckets("words", len(ratios)).alias("buckets"),
    )
    # Only texts with a window found twice are looked at window by window.
    repeated = """if(size(array_distinct(windows)) = size(windows), 0,
        element_at(transform(array(sort_array(transform(windows, (x, i) -> struct(x, i)))), s ->
            size(array_distinct(flatten(transform(
                filter(s, (y, k) -> (k > 0 and get(s, k - 1).x = y.x) or coalesce(get(s, k + 1).x = y.x, false)),
                y -> array(y.i, y.i + 1, y.i + 2)))))), 1))"""
    rows = rows.withColumn("ratios", _as_array(ratios))
    rows = rows.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated).cast("long").alias("n_repeat_words"),
        F.expr(
            "if(size(buckets) = 0, 0D, aggregate(buckets, 0D, (a, b) -> a + get(ratios, b)) / size(buckets))"
        ).alias("llr"),
        # A filter on the verdict must not be pushed below, where it would repeat all of this for each use.
        F.monotonically_increasing_id().alias("once"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold) & (F.col("once") >= 0)).drop("once")


def apply_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Judge every row of docs (doc_id, text), trusting documents whose labels.quality is 1.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr. Null and
    empty texts have no words and fail the base; null and repeated doc_ids are judged row by row; an empty
    table gives no rows; other columns, whatever their names, are ignored. Texts of any length are judged
    whole, each as one row in memory. A ratio equal to the threshold is kept.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    judged = judge(rows, log_ratios(rows, trusted_ids(labels)), threshold)
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "llr",
    )
