"""Connected components by alternating large-star and small-star, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import staged, unstage


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """rows (u, v) with m of least (u, m).

    A node with very many neighbours is one key. Joining on a second column as well deals both sides out
    anew after the aggregation, so that such a key's rows can be split among tasks at run time. It is a
    merge join at every size: neither side has a bound, and a small table should run as a large one does.
    """
    again = least.withColumn("again", -F.col("u")).hint("merge")
    return rows.withColumn("again", -F.col("u")).join(again, ["u", "again"]).drop("again")


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node with the smallest of the node and its neighbours; edges may repeat."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = _with_least(both.filter(F.col("v") > F.col("u")), least)
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(down, least).select(F.col("v").alias("a"), F.col("m").alias("b"))
    moved = moved.filter(F.col("a") != F.col("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a, b), a > b, are stars: every a has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest node of the component of every node that has an edge: node, component, written to the shared folder.

    edges has long columns a and b; loops are dropped, repeated edges and either order are fine. Each
    round is written to the shared folder, so a lost executor costs one round. The caller may unstage()
    the result once it is read. Raises if the rounds don't suffice (they grow with the logarithm of the
    number of nodes).
    """
    now = staged(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    for _ in range(most_rounds):
        after = staged(_small_star(_large_star(now)), "edges")
        unstage(now)
        now = after
        if _settled(now):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    found = staged(now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), "components")
    unstage(now)
    return found
