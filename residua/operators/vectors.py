"""Vectors: pooling positions, joining windows, and weighted and gene-level means.

A state table has a row a position: key columns, pos, and state, an array of numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators.quantiles import beside, exact_quantiles
from residua.session import shuffle_partitions


def long_form(states: DataFrame, keys: list[str], state: str = "state") -> DataFrame:
    """A row a position and dimension: keys, dim (from 0), v."""
    rest = [c for c in states.columns if c != state]
    return states.select(*rest, F.posexplode(F.col(state).cast("array<double>")).alias("dim", "v"))


def _field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def _by_dim(rows: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Aggregate v per key and dimension, then one array a key and aggregate, ordered by dimension."""
    per = rows.groupBy(*keys, "dim").agg(*[a.alias(n) for n, a in aggregates.items()])
    listed = per.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("dim", *aggregates))).alias("d"))
    return listed.select(*keys, *[F.transform("d", _field(n)).alias(n) for n in aggregates])


def mean_pool(states: DataFrame, keys: list[str], state: str = "state") -> DataFrame:
    return _by_dim(long_form(states, keys, state), keys, mean=F.avg("v"))


def mean_sd_pool(states: DataFrame, keys: list[str], state: str = "state") -> DataFrame:
    """mean, sd (of the population), and mean_sd, both in one array."""
    out = _by_dim(long_form(states, keys, state), keys, mean=F.avg("v"), sd=F.stddev_pop("v"))
    return out.withColumn("mean_sd", F.concat("mean", "sd"))


def quantile_pool(states: DataFrame, keys: list[str], state: str = "state") -> DataFrame:
    """Mean, sd and the three quartiles (interpolated), in one array `quantiles`."""
    values = long_form(states, keys, state)
    q = {f"q{p}": p / 100 for p in (25, 50, 75)}
    cuts = exact_quantiles(values, [*keys, "dim"], "v", q)
    listed = cuts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("dim", *q))).alias("d"))  # as many as dimensions
    listed = listed.select(*keys, *[F.transform("d", _field(n)).alias(n) for n in q])
    out = beside(_by_dim(values, keys, mean=F.avg("v"), sd=F.stddev_pop("v")), listed, keys)
    return out.select(*keys, F.concat("mean", "sd", *q).alias("quantiles"))


def weighted_pool(states: DataFrame, keys: list[str], weight: str, state: str = "state", normalise: bool = True) -> DataFrame:
    """Sum of weight * state, divided by the sum of weights unless they are normalised already."""
    w = F.col(weight).cast("double")
    total = F.sum(F.col("v") * w)
    return _by_dim(long_form(states, keys, state), keys, pooled=total / F.sum(w) if normalise else total)


def chunk_control(chunks: DataFrame, keys: list[str], vector: str = "vector", size: str = "size") -> DataFrame:
    """keys, control, plain: the mean of windows' vectors weighted by the windows' lengths, and not weighted.

    What a sequence's vector would be without joining its windows position by position.
    """
    long = long_form(chunks.withColumn("_w", F.col(size).cast("double")), [*keys, "_w"], vector)
    return _by_dim(long, keys, control=F.sum(F.col("v") * F.col("_w")) / F.sum("_w"), plain=F.avg("v"))


def gene_mean_var(vectors: DataFrame, keys: list[str], state: str = "state") -> DataFrame:
    """Mean and population variance over isoforms; one isoform has variance zero."""
    return _by_dim(long_form(vectors, keys, state), keys, mean=F.avg("v"), variance=F.var_pop("v"))


def windows(sequences: DataFrame, length: str, window: int, overlap: int) -> DataFrame:
    """A row a window: chunk (from 0), start, size."""
    starts = F.posexplode(C.chunk_starts(F.col(length), window, overlap)).alias("chunk", "start")
    return sequences.select("*", starts).withColumn("size", F.least(F.lit(window), F.col(length) - F.col("start")))


def taper_coverage(sequences: DataFrame, key: str, length: str, window: int, overlap: int, kind: str) -> DataFrame:
    """Per sequence its positions, and the total and least of the window weights that add up at them: key, positions, total, least.

    Nothing is shuffled; a sequence takes a number a position in one task.
    """
    from residua.operators.encoder import window_starts, window_weights

    window_starts(0, window, overlap), C.taper_named(kind)  # what doesn't fit raises here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = window_weights(window, kind)
        for batch in batches:
            total, least = [], []
            for n in batch.column(1).to_pylist():
                at = np.zeros(n or 0)
                for start in window_starts(n or 0, window, overlap) if n else []:
                    size = min(window, n - start)
                    at[start : start + size] += whole if size == window else window_weights(size, kind)
                total.append(float(at.sum())), least.append(float(at.min()) if n else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total), pa.array(least, pa.float64())], names=[key, "positions", "total", "least"])

    kind_of = sequences.schema[key].dataType.simpleString()
    return sequences.select(key, F.col(length).cast("long")).mapInArrow(run, f"{key} {kind_of}, positions long, total double, least double")


def reconstruct(chunks: DataFrame, keys: list[str], kind: str = "triangular") -> DataFrame:
    """Join the windows' states into one state a position: keys, pos, state.

    chunks: keys, start, length (of the whole), states (array of arrays). Overlaps are averaged with
    taper weights; a position that no window covers raises when read. A single window stays as it is.
    """
    rows = chunks.repartition(shuffle_partitions(chunks.sparkSession), *keys)  # once, as windows; the sums by position then stay where they are
    rows = rows.withColumn("w", C.taper(F.size("states"), kind)).withColumn("single", (F.col("start") == 0) & (F.size("states") == F.col("length")))
    each = rows.select(*keys, "length", "start", "single", F.posexplode(F.arrays_zip("states", "w")).alias("i", "x"))
    w = F.when(F.col("single"), F.lit(1.0)).otherwise(F.col("x.w"))
    each = each.select(*keys, "length", (F.col("start") + F.col("i")).alias("pos"), w.alias("w"), F.col("x.states").alias("state"))
    long = long_form(each, [*keys, "pos"])
    out = _by_dim(long, [*keys, "length", "pos"], state=F.sum(F.col("v") * F.col("w")) / F.sum("w"))
    covered = out.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    out = out.join(covered, keys)
    full = F.when(F.col("_n") == F.col("length"), F.col("pos")).otherwise(F.raise_error(F.lit("a position is not covered")))
    return out.select(*keys, full.cast("int").alias("pos"), "state")


def position_weights(chunks: DataFrame, keys: list[str], kind: str = "triangular") -> DataFrame:
    """Weights of whole sequences from windows' weights: tapered, summed by position, made to sum to one.

    chunks: keys, start, weights (array).
    """
    rows = chunks.withColumn("w", C.taper(F.size("weights"), kind))
    each = rows.select(*keys, "start", F.posexplode(F.arrays_zip("weights", "w")).alias("i", "x"))
    at = each.groupBy(*keys, (F.col("start") + F.col("i")).alias("pos")).agg(F.sum(F.col("x.weights") * F.col("x.w")).alias("w"))
    total = at.groupBy(*keys).agg(F.sum("w").alias("_all"))
    return at.join(total, keys).select(*keys, "pos", (F.col("w") / F.col("_all")).alias("weight"))


def drop_ends(states: Column, length: Column) -> Column:
    """The states between the markers of beginning and end, without padding."""
    return F.slice(states, F.lit(2), length)


def wasserstein_features(states: DataFrame, key: str, reference: np.ndarray, projections: np.ndarray) -> DataFrame:
    """Sliced comparison with a reference set: mean difference of sorted projections, a number a slice.

    Both sides are brought to as many quantiles as the longer one has. One key's states are one group.
    """
    goal = np.sort(reference @ projections, axis=0)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(np.stack(group.sort_values("pos")["state"].to_list()) @ projections, axis=0)
        n = max(len(own), len(goal))
        grid = np.linspace(0, 1, n)
        sides = [[np.interp(grid, np.linspace(0, 1, len(x)), x[:, k]) for k in range(x.shape[1])] for x in (own, goal)]
        return pd.DataFrame({key: [group[key].iloc[0]], "features": [np.mean(np.array(sides[0]) - np.array(sides[1]), axis=1).tolist()]})

    kind = states.schema[key].dataType.simpleString()
    return states.groupBy(key).applyInPandas(one, f"{key} {kind}, features array<double>")


def spectrum(vectors: DataFrame, column: str, dim: int) -> DataFrame:
    """Effective rank and the share of the five largest components of the centred vectors.

    A task adds up the products of its batches, a row a dimension; only the sums of these, dim * dim
    numbers, come to the driver. Null vectors take no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total, count = np.zeros((dim, dim)), np.zeros(dim), 0
        for batch in batches:
            held = batch.column(0).to_pylist()
            if held:
                x = np.array(held, dtype=np.float64)
                gram, total, count = gram + x.T @ x, total + x.sum(axis=0), count + len(x)
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim)), pa.array(np.full(dim, count)), pa.array(total), pa.array(gram.tolist(), pa.list_(pa.float64()))], names=["i", "n", "m", "row"]
            )

    parts = vectors.select(F.col(column).cast("array<double>").alias("x")).filter(F.col("x").isNotNull()).mapInArrow(run, "i long, n long, m double, row array<double>")
    sums = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    cross = parts.select("i", F.posexplode("row").alias("j", "y")).groupBy("i", "j").agg(F.sum("y").alias("s")).collect()
    gram, mean = np.zeros((dim, dim)), np.zeros(dim)
    for r in cross:
        gram[r.i, r.j] = r.s
    for r in sums:
        mean[r.i] = r.m
    n = sums[0].n if sums else 0
    squares = np.clip(np.linalg.eigvalsh(gram - np.outer(mean, mean) / n)[::-1], 0, None) if n else np.zeros(1)
    total = float(squares.sum())
    rank = total**2 / float((squares**2).sum()) if total else 0.0
    top = float(squares[:5].sum()) / total if total else 0.0
    return vectors.sparkSession.createDataFrame([(int(n), rank, top)], "n long, effective_rank double, top5_fraction double")


def pairwise_cosine(vectors: DataFrame, key: str, column: str, most: int = 2000) -> DataFrame:
    """Cosine of every pair of a small set of vectors. Raises for more than `most`: pairs grow with the square."""
    if vectors.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} vectors")
    small = F.broadcast(vectors.select(F.col(key).alias("b"), F.col(column).alias("y")))
    left = vectors.select(F.col(key).alias("a"), F.col(column).alias("x"))
    return left.join(small, F.col("a") < F.col("b")).select("a", "b", C.cosine(F.col("x"), F.col("y")).alias("cosine"))


def medoid(vectors: DataFrame, group: str, key: str, column: str, most: int = 1000) -> DataFrame:
    """The member nearest to the others of its group, by summed distance; ties to the smaller key.

    Raises for a group of more than `most`: distances grow with its square.
    """
    if not vectors.groupBy(group).count().filter(F.col("count") > most).isEmpty():
        raise ValueError(f"a group of more than {most} vectors")
    left = vectors.select(group, F.col(key).alias("a"), F.col(column).alias("x"))
    right = vectors.select(group, F.col(key).alias("b"), F.col(column).alias("y"))
    sums = left.join(right, group).groupBy(group, "a").agg(F.sum(C.l2_distance(F.col("x"), F.col("y"))).alias("s"))
    return sums.groupBy(group).agg(F.min(F.struct("s", "a")).alias("r")).select(group, F.col("r.a").alias(key), F.col("r.s").alias("total_distance"))
