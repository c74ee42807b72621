"""Queries that compare runs, precisions, windows and weights, as pilots of an extraction do."""

from __future__ import annotations

from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators import batching, medoids, metrics, vectors
from residua.plans.registry import query
from residua.session import table

_PAIR = """SELECT vec_id, label, CAST(u.v AS DOUBLE) AS a, CAST(u.v AS DOUBLE) * 0.5 + 0.01 AS b FROM embeddings, unnest(embedding) AS u(v)"""
_BINS = [(100, 500), (501, 1500), (1501, 3000), (3001, 9000)]
_COUNT = 50
_WINDOW, _OVERLAP = 40, 16


def _pair(spark, sf_dir):
    """Each vector, and the same one as a second run might have given it."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("a"))
    return rows, rows.select("vec_id", F.transform("a", lambda x: x * 0.5 + 0.01).alias("a"))


@query(f"""SELECT vec_id, round(sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 6) AS cosine, round(max(abs(a - b)), 6) AS max_abs_error, round(avg(abs(a - b)), 6) AS mean_abs_error,
round(sqrt(sum((a - b) * (a - b))) / sqrt(sum(b * b)), 6) AS relative_l2, true AS finite FROM ({_PAIR}) GROUP BY vec_id""")
def vec_agreement(spark, sf_dir):
    """Agreement of two runs by key."""
    out = metrics.vector_agreement(*_pair(spark, sf_dir), "vec_id", "a")
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in ("cosine", "max_abs_error", "mean_abs_error", "relative_l2")], "finite")


@query(f"""SELECT count(*) AS n, round(max(m), 6) AS max_abs_diff, round(avg(d), 6) AS mean_abs_diff, round(min(c), 6) AS least_cosine, round(avg(c), 6) AS mean_cosine, count(*) FILTER (WHERE m <= 0.05) AS within
FROM (SELECT max(abs(a - b)) AS m, avg(abs(a - b)) AS d, sum(a * b) / sqrt(sum(a * a) * sum(b * b)) AS c FROM ({_PAIR}) GROUP BY vec_id)""")
def vec_repeatability(spark, sf_dir):
    """How far a second run is from the first, over all keys."""
    out = metrics.repeatability(*_pair(spark, sf_dir), "vec_id", "a", 0.05)
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("max_abs_diff", "mean_abs_diff", "least_cosine", "mean_cosine")], "within")


@query("""SELECT label, count(*) AS n, round(avg(norm), 6) AS mean_norm, round(coalesce(corr(norm, n_chars), 0), 6) AS norm_length_correlation
FROM (SELECT vec_id, label, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS norm FROM embeddings) JOIN documents ON doc_id = vec_id GROUP BY label""")
def vec_norm_length(spark, sf_dir):
    """Mean norm of each family's vectors, and how norms go with the lengths of their texts."""
    lengths = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "n_chars")
    out = metrics.norm_length(table(spark, sf_dir, "embeddings").join(lengths, "vec_id"), ["label"], "embedding", "n_chars")
    return out.select("label", "n", F.round("mean_norm", 6).alias("mean_norm"), F.round(F.coalesce("norm_length_correlation", F.lit(0.0)), 6).alias("norm_length_correlation"))


@query("""SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(sum(v * w) / sum(w), 6) AS control, round(avg(v), 6) AS plain
FROM (SELECT label, vec_id % 7 + 1 AS w, u.i, CAST(u.v AS DOUBLE) AS v FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(v, i)) GROUP BY ALL""")
def vec_chunk_control(spark, sf_dir):
    """The mean of window vectors, weighted by the windows' lengths and plain: vectors of a label stand for its windows."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.col("embedding").alias("vector"), (F.col("vec_id") % 7 + 1).alias("size"))
    out = vectors.chunk_control(rows, ["label"], "vector", "size").select("label", F.posexplode(F.arrays_zip("control", "plain")).alias("dim", "x"))
    return out.select("label", "dim", F.round("x.control", 6).alias("control"), F.round("x.plain", 6).alias("plain"))


@query(f"""WITH w AS (SELECT vec_id, s, unnest(range(least({_WINDOW}, 64 - s))) AS i, least({_WINDOW}, 64 - s) AS size, embedding FROM embeddings, (VALUES (0), (24)) t(s)),
x AS (SELECT vec_id, s + i AS pos, greatest(1 - abs(-1 + 2.0 * i / (size - 1)), 1.0 / size) AS t, CAST(embedding[CAST(s + i + 1 AS INTEGER)] AS DOUBLE) + s * 0.001 AS v FROM w)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(sum(v * t) / sum(t), 6) AS state FROM x GROUP BY ALL""")
def vec_reconstruct(spark, sf_dir):
    """Vectors as sequences of 64 positions, cut into two windows that differ where they overlap, and joined again."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    start = F.explode(C.chunk_starts(F.size("v"), _WINDOW, _OVERLAP)).alias("start")
    chunks = rows.select("vec_id", F.size("v").alias("length"), "v", start)
    chunks = chunks.withColumn("part", F.slice("v", F.col("start") + 1, F.lit(_WINDOW)))
    states = F.transform("part", lambda x: F.array(x + F.col("start") * 0.001)).alias("states")
    out = vectors.reconstruct(chunks.select("vec_id", "start", "length", states), ["vec_id"])
    return out.select("vec_id", "pos", F.round(F.col("state")[0], 6).alias("state"))


@query(f"""WITH h AS (SELECT sha256(text) AS sequence_hash, min(n_chars) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1),
b AS (SELECT *, CASE {" ".join(f"WHEN n BETWEEN {a} AND {z} THEN {k}" for k, (a, z) in enumerate(_BINS))} END AS bin FROM h),
p AS (SELECT sequence_hash, n FROM b WHERE bin IS NOT NULL QUALIFY row_number() OVER (PARTITION BY bin ORDER BY sequence_hash) <= {max(1, _COUNT // len(_BINS))}),
o AS (SELECT *, 0 AS o FROM p UNION ALL SELECT sequence_hash, n, 1 FROM h WHERE sequence_hash NOT IN (SELECT sequence_hash FROM p))
SELECT sequence_hash, n FROM o ORDER BY o, sequence_hash LIMIT {_COUNT}""")
def seq_stratified_sample(spark, sf_dir):
    """A fixed sample with as many of each length as there are, filled up in the order of the hashes (the sample is the feature)."""
    rows = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).groupBy(C.sequence_hash(F.col("text")).alias("sequence_hash")).agg(F.min("n_chars").alias("n"))
    return batching.stratified_sample(rows, "n", "sequence_hash", _BINS, _COUNT)


@query("""WITH v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.label, a.vec_id, sum(list_distance(a.x, b.x)) AS total FROM v a JOIN v b ON b.label = a.label GROUP BY ALL)
SELECT label, vec_id, round(total, 6) AS total_distance FROM s QUALIFY row_number() OVER (PARTITION BY label ORDER BY total, vec_id) = 1""")
def vec_medoid(spark, sf_dir):
    """The vector of each label with the least sum of distances to the others."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("label").isNotNull())
    return medoids.exact_medoid(rows, "label", "vec_id", "embedding").select("label", "vec_id", F.round("total_distance", 6).alias("total_distance"))
