"""Queries on vectors, weights and graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators import checks, encoder, graph, layers, metrics, vectors
from residua.plans.registry import query
from residua.session import shared_dir, table
from residua.sources import npy, sinks

#: Event types that a row and a broadcast hold, at most.
MOST_KINDS = 1000
_LONG = "SELECT label, vec_id, CAST(u.i AS INTEGER) - 1 AS dim, CAST(u.v AS DOUBLE) AS v FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(v, i)"


def _states(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").alias("state"))


def _flat(df, key, *names):
    """Array columns as rows: key, dim and a rounded number each."""
    zipped = F.posexplode(F.arrays_zip(*names)).alias("dim", "x")
    return df.select(key, zipped).select(key, "dim", *[F.round(F.col(f"x.{n}"), 6).alias(n) for n in names])


@query(f"SELECT label, dim, round(avg(v), 6) AS mean FROM ({_LONG}) GROUP BY ALL")
def vec_mean_pool(spark, sf_dir):
    return _flat(vectors.mean_pool(_states(spark, sf_dir), ["label"]), "label", "mean")


@query(f"SELECT label, dim, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd FROM ({_LONG}) GROUP BY ALL")
def vec_mean_sd_pool(spark, sf_dir):
    return _flat(vectors.mean_sd_pool(_states(spark, sf_dir), ["label"]), "label", "mean", "sd")


@query(f"""WITH q AS (SELECT label, dim, avg(v) AS a, stddev_pop(v) AS b, quantile_cont(v, 0.25) AS c, quantile_cont(v, 0.5) AS d, quantile_cont(v, 0.75) AS e, max(dim) OVER () + 1 AS n
FROM ({_LONG}) GROUP BY label, dim)
SELECT label, CAST(dim + k * n AS INTEGER) AS dim, round([a, b, c, d, e][k + 1], 6) AS quantiles FROM q, unnest(range(5)) AS u(k)""")
def vec_quantile_pool(spark, sf_dir):
    return _flat(vectors.quantile_pool(_states(spark, sf_dir), ["label"]), "label", "quantiles")


@query(f"SELECT label, dim, round(sum(v * (vec_id + 1)) / sum(vec_id + 1), 6) AS pooled FROM ({_LONG}) GROUP BY ALL")
def vec_weighted_pool(spark, sf_dir):
    return _flat(vectors.weighted_pool(_states(spark, sf_dir).withColumn("w", F.col("vec_id") + 1), ["label"], "w"), "label", "pooled")


@query(f"SELECT label, dim, round(avg(v), 6) AS mean, round(var_pop(v), 6) AS variance FROM ({_LONG}) GROUP BY ALL")
def vec_gene_mean_var(spark, sf_dir):
    return _flat(vectors.gene_mean_var(_states(spark, sf_dir), ["label"]), "label", "mean", "variance")


@query(f"""WITH m AS (SELECT label, dim, avg(v) AS v FROM ({_LONG}) GROUP BY ALL), c AS (SELECT label, list(v ORDER BY dim) AS v FROM m GROUP BY label)
SELECT x.label AS a, y.label AS b, round(list_cosine_similarity(x.v, y.v), 6) AS cosine FROM c x JOIN c y ON x.label < y.label""")
def vec_centroid_cosine(spark, sf_dir):
    pairs = vectors.pairwise_cosine(vectors.mean_pool(_states(spark, sf_dir), ["label"]), "label", "mean")
    return pairs.select("a", "b", F.round("cosine", 6).alias("cosine"))


@query(f"""WITH m AS (SELECT label, dim, avg(v) AS v FROM ({_LONG}) GROUP BY ALL), c AS (SELECT label, list(v ORDER BY dim) AS v FROM m GROUP BY label),
p AS (SELECT e.label, list_cosine_similarity(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)), c.v) AS c FROM embeddings e JOIN c USING (label))
SELECT label, round(avg(c), 6) AS mean_cosine, round(quantile_disc(c, 0.5), 6) AS median_cosine, round(quantile_cont(c, 0.01), 6) AS p01_cosine FROM p GROUP BY label""")
def vec_reconstruction_error(spark, sf_dir):
    """Every vector against its group's mean: mean, lower median and first percentile of the cosine."""
    states = _states(spark, sf_dir)
    pairs = states.join(vectors.mean_pool(states, ["label"]), "label").withColumn("state", F.col("state").cast("array<double>"))
    out = metrics.reconstruction_error(pairs, ["label"], "state", "mean")
    return out.select("label", *[F.round(c, 6).alias(c) for c in ("mean_cosine", "median_cosine", "p01_cosine")])


@query("""WITH w AS (SELECT user_id, event_type, sum(abs(value)) + 1 AS s FROM events GROUP BY ALL), t AS (SELECT user_id, event_type, s / sum(s) OVER (PARTITION BY user_id) AS p FROM w),
g AS (SELECT event_type, sum(s) / (SELECT sum(s) FROM w) AS q FROM w GROUP BY 1),
j AS (SELECT u.user_id, g.event_type, g.q, coalesce(t.p, 0) AS p FROM (SELECT DISTINCT user_id FROM w) u, g LEFT JOIN t ON t.user_id = u.user_id AND t.event_type = g.event_type)
SELECT user_id, round(sum(p * q) / sqrt(sum(p * p) * sum(q * q)), 6) AS cosine, round(max(abs(p - q)), 6) AS max_abs_error,
round(sqrt(greatest(0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END), 0)), 6) AS js_distance
FROM j GROUP BY user_id""")
def vec_weight_agreement(spark, sf_dir):
    """Each user's shares of event types against those of all users. Raises for more types than a row should hold."""
    if table(spark, sf_dir, "events").select("event_type").distinct().limit(MOST_KINDS + 1).count() > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} event types")
    w = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg((F.sum(F.abs("value")) + 1).alias("s"))
    kinds = w.groupBy("event_type").agg(F.sum("s").alias("s")).agg(F.array_sort(F.collect_list(F.struct("event_type", "s"))).alias("all"), F.lit(1).alias("one"))
    users = w.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "s"))).alias("m"), F.lit(1).alias("one")).join(F.broadcast(kinds), "one")

    def shares(values):
        total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
        return F.transform(values, lambda x: x / total)

    own = F.transform("all", lambda x: F.coalesce(F.try_element_at("m", x["event_type"]), F.lit(0.0)))
    rows = users.select("user_id", shares(own).alias("p"), shares(F.transform("all", lambda x: x["s"])).alias("q"))
    out = metrics.weight_agreement(rows, "p", "q", "user_id")
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("cosine", "max_abs_error", "js_distance")])


@query("""SELECT event_type, count(*) AS n, round(sum(p), 6) AS total, round(sum(-p * ln(greatest(p, 1e-12))), 6) AS entropy,
round(exp(sum(-p * ln(greatest(p, 1e-12)))), 4) AS effective FROM (
SELECT event_type, s / sum(s) OVER (PARTITION BY event_type) AS p FROM (SELECT event_type, user_id, sum(abs(value)) AS s FROM events GROUP BY 1, 2)) GROUP BY 1""")
def vec_weight_entropy(spark, sf_dir):
    w = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.sum(F.abs("value")).alias("s"))
    profile = metrics.share_entropy(w, ["event_type"], "s")
    whole = F.round(F.col("total") / F.col("total"), 6).alias("total")
    return profile.select("event_type", "n", whole, F.round("entropy", 6).alias("entropy"), F.round("effective_positions", 4).alias("effective"))


@query("SELECT l_suppkey, l_linenumber, max(l_extendedprice) AS w FROM lineitem GROUP BY ALL")
def vec_max_reduce(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("i"), F.col("l_linenumber").alias("j"), F.col("l_extendedprice").alias("w"))
    return graph.reduce_attention(rows, []).select(F.col("i").alias("l_suppkey"), F.col("j").alias("l_linenumber"), "w")


_EDGES = """SELECT s_nationkey AS i, c_nationkey AS j, sum(l_quantity) AS w FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL"""


def _trade(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("j"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("i"))
    return line.join(orders, "l_orderkey").join(customer, "o_custkey").join(supplier, "l_suppkey").groupBy("i", "j").agg(F.sum("l_quantity").alias("w"))


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({_EDGES}), o AS MATERIALIZED (SELECT i, sum(w) AS s FROM e GROUP BY i),
n AS MATERIALIZED (SELECT DISTINCT k FROM (SELECT i AS k FROM e UNION ALL SELECT j FROM e)), c AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS c FROM n),
r AS (SELECT 0 AS t, list({{'k': k, 's': 1 / c}} ORDER BY k) AS v FROM n, c
UNION ALL SELECT t + 1, (SELECT list({{'k': n.k, 's': 0.85 * (coalesce(f.s, 0) + coalesce(d.s, 0) / c.c) + 0.15 / c.c}} ORDER BY n.k)
  FROM n CROSS JOIN c LEFT JOIN (SELECT e.j AS k, sum(x.u.s * e.w / o.s) AS s FROM (SELECT unnest(r.v) AS u) x JOIN e ON e.i = x.u.k JOIN o ON o.i = e.i GROUP BY e.j) f ON f.k = n.k
  CROSS JOIN (SELECT sum(x.u.s) AS s FROM (SELECT unnest(r.v) AS u) x WHERE x.u.k NOT IN (SELECT i FROM o)) d) FROM r WHERE t < 8)
SELECT u.k AS node, round(u.s, 9) AS score FROM (SELECT unnest(v) AS u FROM r WHERE t = 8)""")
def graph_pagerank(spark, sf_dir):
    """Eight rounds of PageRank on the trade between nations."""
    return graph.edge_pagerank(_trade(spark, sf_dir), exact=8).select("node", F.round("score", 9).alias("score"))


@query()
def graph_pagerank_by_month(spark, sf_dir):
    """PageRank of many small graphs, one a month of shipping."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("j"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("i"))
    rows = line.join(orders, "l_orderkey").join(customer, "o_custkey").join(supplier, "l_suppkey")
    return graph.grouped_pagerank(rows.groupBy("month", "i", "j").agg(F.sum("l_quantity").alias("w")), "month")


@query("""SELECT 'unique sequence_hash' AS "check", count(*) - count(DISTINCT vec_id) AS failures, count(*) = count(DISTINCT vec_id) AS ok FROM embeddings
UNION ALL SELECT 'filled sequence_hash', count(*) FILTER (WHERE vec_id IS NULL), count(*) FILTER (WHERE vec_id IS NULL) = 0 FROM embeddings
UNION ALL SELECT 'status ok', count(*) FILTER (WHERE vec_id % 50 = 7), count(*) FILTER (WHERE vec_id % 50 = 7) = 0 FROM embeddings
UNION ALL SELECT 'positive length', count(*) FILTER (WHERE vec_id % 9 = 0), count(*) FILTER (WHERE vec_id % 9 = 0) = 0 FROM embeddings
UNION ALL SELECT 'mean size', count(*) FILTER (WHERE len(embedding) <> 64), count(*) FILTER (WHERE len(embedding) <> 64) = 0 FROM embeddings
UNION ALL SELECT 'mean finite', count(*) FILTER (WHERE NOT list_bool_and(list_transform(embedding, lambda x: isfinite(x)))), count(*) FILTER (WHERE NOT list_bool_and(list_transform(embedding, lambda x: isfinite(x)))) = 0 FROM embeddings""")
def vec_bank_checks(spark, sf_dir):
    """Checks of a bank in which some rows have failed and some have no length."""
    status = F.when(F.col("vec_id") % 50 == 7, "failed").otherwise("ok")
    bank = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sequence_hash"), (F.col("vec_id") % 9).alias("length"), F.lit(1).alias("chunk_count"), status.alias("status"), F.col("embedding").alias("mean")
    )
    return checks.bank_checks(bank, {"mean": 64})


@query("""SELECT vec_id, CAST(count(*) AS INTEGER) AS n, round(sum(v), 5) AS total FROM (SELECT vec_id, unnest(embedding[2:vec_id % 40 + 1]) AS v FROM embeddings WHERE vec_id % 40 > 0) GROUP BY 1""")
def vec_drop_ends(spark, sf_dir):
    """Of padded states with a marker at either end, those of the residues."""
    rows = table(spark, sf_dir, "embeddings").filter("vec_id % 40 > 0").select("vec_id", vectors.drop_ends(F.col("embedding"), (F.col("vec_id") % 40).cast("int")).alias("s"))
    return rows.select("vec_id", F.size("s").alias("n"), F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query()
def vec_spectrum(spark, sf_dir):
    """Effective rank and leading share of all vectors."""
    return vectors.spectrum(table(spark, sf_dir, "embeddings"), "embedding", 64)


@query()
def vec_extract_features(spark, sf_dir):
    """Features of every text by the stand-in encoder, long ones in windows."""
    rows = table(spark, sf_dir, "benchmark").select(C.sequence_hash(F.col("text")).alias("sequence_hash"), F.col("text").alias("amino_acid_sequence"))
    return encoder.extract_features(rows)


@query("""SELECT row_number() OVER (ORDER BY sha256(CAST(vec_id AS VARCHAR))) - 1 AS row, sha256(CAST(vec_id AS VARCHAR)) AS sequence_hash,
CAST(len(embedding) AS INTEGER) AS width, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last FROM embeddings WHERE embedding IS NOT NULL""")
def vec_npy_matrix(spark, sf_dir):
    """The embeddings written as one hash-sorted matrix file, each task its own rows, and read back by ranges of rows."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull())
    path = f"{shared_dir(spark).rstrip('/')}/matrix-{uuid.uuid4().hex}/embedding"
    sinks.export_npy(rows.select(F.sha2(F.col("vec_id").cast("string"), 256).alias("sequence_hash"), "embedding"), "embedding", path)
    back = npy.read_npy(spark, path, ("row", "sequence_hash", "vector"), rows=200)
    v = F.col("vector")
    return back.select("row", "sequence_hash", F.size(v).alias("width"), F.get(v, F.lit(0)).cast("double").alias("first"), F.element_at(v, -1).cast("double").alias("last"))


@query("""SELECT label, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, max(CAST(embedding[8 * i + j + 1] AS DOUBLE)) AS w
FROM embeddings, range(8) a(i), range(8) b(j) WHERE embedding IS NOT NULL AND label IS NOT NULL GROUP BY ALL""")
def vec_layer_maximum(spark, sf_dir):
    """Each label's vectors as 8 x 8 weights of its layers, reduced to their largest."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull() & F.col("label").isNotNull())
    rows = rows.select("label", F.slice("embedding", 1, 64).alias("weights"))
    one = layers.layer_maximum(rows, "label", "weights").select("label", F.posexplode("weights").alias("k", "w"))
    return one.select("label", F.floor(F.col("k") / 8).cast("int").alias("i"), (F.col("k") % 8).alias("j"), F.col("w").cast("double").alias("w"))
