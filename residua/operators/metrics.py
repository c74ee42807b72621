"""Comparing vectors and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators.quantiles import beside, exact_quantiles


def vector_agreement(left: DataFrame, right: DataFrame, key: str, vector: str) -> DataFrame:
    """Per key: cosine, largest and mean absolute error, relative L2, and whether both are finite."""
    a, b = left.select(key, F.col(vector).alias("a")), right.select(key, F.col(vector).alias("b"))
    x, y = F.col("a"), F.col("b")
    return a.join(b, key).select(
        key,
        C.cosine(x, y).alias("cosine"),
        C.max_abs_error(x, y).alias("max_abs_error"),
        C.mean_abs_error(x, y).alias("mean_abs_error"),
        C.relative_l2(x, y).alias("relative_l2"),
        (C.all_finite(x) & C.all_finite(y)).alias("finite"),
    )


def repeatability(first: DataFrame, second: DataFrame, key: str, vector: str, tolerance: float) -> DataFrame:
    """One row on two runs: keys compared, largest and mean absolute difference, least and mean cosine, keys within the tolerance."""
    each = vector_agreement(first, second, key, vector)
    return each.agg(
        F.count(F.lit(1)).alias("n"), F.max("max_abs_error").alias("max_abs_diff"), F.avg("mean_abs_error").alias("mean_abs_diff"),
        F.min("cosine").alias("least_cosine"), F.avg("cosine").alias("mean_cosine"), F.count_if(F.col("max_abs_error") <= tolerance).alias("within"),
    )


def norm_length(rows: DataFrame, keys: list[str], vector: str, length: str) -> DataFrame:
    """keys, n, mean_norm, norm_length_correlation: whether vectors of longer sequences have larger norms. Null if either doesn't vary."""
    each = rows.select(*keys, C.norm(F.col(vector).cast("array<double>")).alias("norm"), F.col(length).cast("double").alias("length"))
    return each.groupBy(*keys).agg(F.count("norm").alias("n"), F.avg("norm").alias("mean_norm"), F.corr("norm", "length").alias("norm_length_correlation"))


def summary(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Smallest, largest and mean value of each metric, a row each."""
    one = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("v")) for n in names])).alias("m")
    return metrics.select(one).groupBy("m.metric").agg(F.min("m.v").alias("least"), F.max("m.v").alias("most"), F.avg("m.v").alias("mean"))


def weight_agreement(pairs: DataFrame, p: str, q: str, *keep: str) -> DataFrame:
    """Cosine, Pearson correlation, largest error, Jensen-Shannon distance and divergence of two weight arrays."""
    x, y = F.col(p).cast("array<double>"), F.col(q).cast("array<double>")

    def centred(c):
        mean = F.aggregate(c, F.lit(0.0), lambda a, v: a + v) / F.size(c)
        return F.transform(c, lambda v: v - mean)

    return pairs.select(
        *keep,
        C.cosine(x, y).alias("cosine"),
        C.cosine(centred(x), centred(y)).alias("pearson"),
        C.max_abs_error(x, y).alias("max_abs_error"),
        C.js_distance(x, y).alias("js_distance"),
        C.js_divergence(x, y).alias("js_divergence"),
    )


def weight_profile(rows: DataFrame, weights: str, *keep: str) -> DataFrame:
    """Sum, least, most, entropy, its exponential, and the correlation with the position."""
    w = F.col(weights).cast("array<double>")
    each = rows.select(*keep, F.posexplode(w).alias("pos", "w"))
    e = F.sum(-F.col("w") * F.log(F.greatest("w", F.lit(1e-12))))
    return each.groupBy(*keep).agg(
        F.sum("w").alias("total"),
        F.min("w").alias("least"),
        F.max("w").alias("most"),
        e.alias("entropy"),
        F.exp(e).alias("effective_positions"),
        F.corr("pos", "w").alias("position_correlation"),
    )


def share_entropy(rows: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Entropy of each key's weights as shares of their sum: keys, n, total, entropy, effective_positions.

    From sums alone, so a key may have any number of rows; weights of zero and less count in n only.
    """
    w = F.when(F.col(weight) > 0, F.col(weight).cast("double"))
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(w).alias("t"), F.sum(w * F.log(w)).alias("wl"))
    entropy = F.log("t") - F.col("wl") / F.col("t")
    return sums.select(*keys, "n", F.col("t").alias("total"), entropy.alias("entropy"), F.exp(entropy).alias("effective_positions"))


def reconstruction_error(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Over positions: mean, lower median and first percentile of cosine, RMSE, mean and 99th percentile of L2."""
    x, y = F.col(a), F.col(b)
    each = pairs.select(*keys, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), C.cosine(x, y))).alias("c"), C.l2_distance(x, y).alias("d"), F.size(a).alias("n"))
    sums = each.groupBy(*keys).agg(F.avg("c").alias("mean_cosine"), F.sqrt(F.sum(F.col("d") * F.col("d")) / F.sum("n")).alias("rmse"), F.avg("d").alias("mean_l2"))
    cosine = exact_quantiles(each, keys, "c", {"median_cosine": 0.5, "p01_cosine": 0.01}, discrete=("median_cosine",)).drop("n")
    distance = exact_quantiles(each, keys, "d", {"p99_l2": 0.99}).drop("n")
    sums = beside(beside(sums, cosine, keys), distance, keys)
    return sums.select(*keys, "mean_cosine", "median_cosine", "p01_cosine", "rmse", "mean_l2", "p99_l2")


def length_statistics(rows: DataFrame, column: str) -> DataFrame:
    """Count, least, most, mean and exact interpolated quantiles; nulls for an empty table."""
    at = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    c = F.col(column)
    sums = rows.agg(F.count(c).alias("n"), F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean"))
    return beside(sums, exact_quantiles(rows, [], column, at).drop("n"), [])
