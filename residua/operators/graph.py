"""Weighted PageRank: dense per sequence in numpy; for one large graph, or many at once, on edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import shuffle_partitions, staged, unstage

ALPHA, TOLERANCE, ROUNDS = 0.85, 1e-6, 100
#: Nodes of a graph that one row is spread into, and rounds between looks at which graphs have settled.
BLOCK, LOOK = 1 << 16, 4


def reduce_attention(attention: DataFrame, keys: list[str]) -> DataFrame:
    """Largest weight over layers and heads: keys, i, j, w. attention: keys, layer, head, i, j, w."""
    return attention.groupBy(*keys, "i", "j").agg(F.max("w").alias("w"))


def reduce_attention_array(attention: np.ndarray) -> np.ndarray:
    """The same for an array of layers, heads and a square."""
    if attention.ndim != 4 or attention.shape[2] != attention.shape[3]:
        raise ValueError("attention must be layers x heads x n x n")
    return attention.max(axis=(0, 1))


def pagerank(matrix: np.ndarray, alpha: float = ALPHA, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> tuple[np.ndarray, int, bool]:
    """Scores of a dense weighted graph, the rounds taken, and whether they settled.

    Rows are normalised; what a node without out-edges holds is spread evenly.
    """
    if matrix.ndim != 2 or matrix.shape[0] != matrix.shape[1] or not np.isfinite(matrix).all():
        raise ValueError("the matrix must be square and finite")
    m = matrix.astype(np.float64)
    n = len(m)
    out = m.sum(axis=1)
    ends = out == 0
    step = np.divide(m, out[:, None], where=~ends[:, None], out=np.zeros_like(m))
    score = np.full(n, 1 / n)
    for k in range(1, rounds + 1):
        after = alpha * (score @ step + score[ends].sum() / n) + (1 - alpha) / n
        moved, score = np.abs(after - score).sum(), after
        if moved < n * tolerance:
            return score, k, True
    return score, rounds, False


def residue_weights(matrix: np.ndarray, **options: float) -> np.ndarray:
    """PageRank without the first and last node, made to sum to one, in single precision."""
    score, _, _ = pagerank(matrix, **options)
    inner = score[1:-1]
    return (inner / inner.sum()).astype(np.float32)


def _nodes(sizes: DataFrame) -> DataFrame:
    """A row a node, 0 to n - 1, of each graph (_g, n); a graph's nodes are made in blocks."""
    blocks = sizes.select("_g", "n", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(BLOCK))).alias("first"))
    blocks = blocks.repartition(shuffle_partitions(sizes.sparkSession), "_g", "first")
    return blocks.select("_g", "n", F.explode(F.sequence("first", F.least(F.col("first") + BLOCK, F.col("n")) - 1)).alias("node"))


def grouped_pagerank(
    edges: DataFrame, key: str, trim: bool = False, alpha: float = ALPHA, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> DataFrame:
    """PageRank of many graphs at once: key, node, score, rounds, converged.

    edges: key, i, j, w with nodes numbered from 0; parallel edges add up. All graphs take a round together,
    on edges and scores keyed by graph and node, so graphs may be of any size and number. What dangling nodes
    hold and how much scores moved is summed by graph; a graph that has settled keeps its scores, and leaves
    the working set at the next look. trim drops the first and last node and renormalises.
    """
    g = F.struct(F.col(key).alias("k"))  # so that a null key is a graph like others
    rows = edges.select(g.alias("_g"), F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("w").cast("double").alias("w"))
    sizes = rows.groupBy("_g").agg((F.max(F.greatest("i", "j")) + 1).alias("n"))
    weights = rows.filter(F.col("w") > 0).groupBy("_g", "i", "j").agg(F.sum("w").alias("w"))
    out = weights.groupBy("_g", "i").agg(F.sum("w").alias("out"))
    step = staged(weights.join(out, ["_g", "i"]).select("_g", "i", "j", (F.col("w") / F.col("out")).alias("p")), "step")
    sources = step.select("_g", F.col("i").alias("node"), F.lit(True).alias("has_out")).distinct()
    start = _nodes(sizes).join(sources, ["_g", "node"], "left").select(
        "_g", "node", "n", (F.lit(1.0) / F.col("n")).alias("score"), F.lit(None).cast("double").alias("before"), F.col("has_out").isNull().alias("dangling"), F.lit(0).alias("rounds")
    )
    ranks, done = staged(start, "ranks"), []

    def state() -> DataFrame:
        moved = F.sum(F.abs(F.col("score") - F.col("before")))
        held = F.coalesce(F.sum(F.when(F.col("dangling"), F.col("score"))), F.lit(0.0))
        found = ranks.groupBy("_g").agg(moved.alias("moved"), held.alias("held"), F.max("n").alias("_n"))
        return found.select("_g", "held", F.coalesce(F.col("moved") >= F.col("_n") * tolerance, F.lit(True)).alias("active"))

    for k in range(rounds):
        sent = step.join(ranks.select("_g", F.col("node").alias("i"), "score"), ["_g", "i"]).select("_g", F.col("j").alias("node"), (F.col("p") * F.col("score")).alias("flow"))
        # A node's own row and what its neighbours send it meet in one aggregation.
        kept = ranks.columns[2:]
        both = sent.unionByName(ranks.select("_g", "node", F.struct(*kept).alias("own")), allowMissingColumns=True)
        both = both.groupBy("_g", "node").agg(F.coalesce(F.sum("flow"), F.lit(0.0)).alias("flow"), F.max("own").alias("own")).select("_g", "node", "flow", "own.*")
        moved = alpha * (F.col("flow") + F.col("held") / F.col("n")) + (1 - alpha) / F.col("n")
        after = both.join(state(), "_g").select(
            "_g", "node", "n", F.when(F.col("active"), moved).otherwise(F.col("score")).alias("score"),
            F.when(F.col("active"), F.col("score")).otherwise(F.col("before")).alias("before"), "dangling", (F.col("rounds") + F.col("active").cast("int")).alias("rounds"),
        )
        after = staged(after, "ranks")
        unstage(ranks)
        ranks = after
        if k % LOOK == LOOK - 1:
            now = staged(ranks.join(state().select("_g", "active"), "_g"), "ranks")
            unstage(ranks)
            done.append(now.filter(~F.col("active")))
            ranks = now.filter("active").drop("active")
            if ranks.isEmpty():
                break
            ranks = staged(ranks, "ranks")
    else:
        done.append(ranks.join(state().select("_g", "active"), "_g").select(*ranks.columns, "active"))
    found = done[0] if done else ranks.withColumn("active", F.lit(True))
    for more in done[1:]:
        found = found.unionByName(more)
    unstage(step)
    if trim:
        found = found.filter((F.col("node") > 0) & (F.col("node") < F.col("n") - 1))
        total = found.groupBy("_g").agg(F.sum("score").alias("total"))
        found = found.join(total, "_g").withColumn("score", F.col("score") / F.col("total"))
    return found.select(F.col("_g.k").alias(key), "node", "score", "rounds", (~F.col("active")).alias("converged"))


def edge_pagerank(edges: DataFrame, alpha: float = ALPHA, tolerance: float = TOLERANCE, rounds: int = ROUNDS, exact: int | None = None) -> DataFrame:
    """PageRank of one large graph: node, score. edges: i, j, w; parallel edges add up, zeros don't count.

    Each round is two aggregations by node, written to the shared folder; of the graph only the number
    of nodes, the dangling mass and the change come to the driver. exact: run so many rounds, not until
    the scores settle.
    """
    edges = edges.filter(F.col("w") > 0).groupBy("i", "j").agg(F.sum("w").alias("w"))
    nodes = edges.select(F.col("i").alias("node")).unionByName(edges.select(F.col("j").alias("node"))).distinct()
    out = edges.groupBy("i").agg(F.sum("w").alias("out"))
    step = staged(edges.join(out, "i").select("i", "j", (F.col("w") / F.col("out")).alias("p")), "step")
    n = nodes.count()
    if not n:
        unstage(step)
        return nodes.withColumn("score", F.lit(0.0))
    sources = step.select(F.col("i").alias("node"), F.lit(True).alias("has_out")).distinct()
    ranks = staged(nodes.join(sources, "node", "left").select("node", F.lit(1.0 / n).alias("score"), F.col("has_out").isNull().alias("dangling")), "ranks")
    loose = ranks.agg(F.sum(F.when(F.col("dangling"), F.col("score"))).alias("s")).first().s or 0.0
    for _ in range(exact or rounds):
        flow = step.join(ranks.select(F.col("node").alias("i"), "score"), "i").groupBy(F.col("j").alias("node")).agg(F.sum(F.col("p") * F.col("score")).alias("f"))
        after = ranks.join(flow, "node", "left").select(
            "node",
            (alpha * (F.coalesce("f", F.lit(0.0)) + F.lit(loose / n)) + (1 - alpha) / n).alias("score"),
            "dangling",
            F.col("score").alias("before"),
        )
        after = staged(after, "ranks")
        unstage(ranks)
        held = F.sum(F.when(F.col("dangling"), F.col("score"))).alias("s")
        state = after.agg(F.sum(F.abs(F.col("score") - F.col("before"))).alias("d"), held).first()
        ranks, loose = after.drop("before"), state.s or 0.0
        if exact is None and state.d < n * tolerance:
            break
    unstage(step)
    return ranks.select("node", "score")
