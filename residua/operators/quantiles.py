"""Exact quantiles of any number of values a key, by narrowing value ranges to the ranks wanted.

A key's values between the least and the greatest are counted in CELLS ranges; each rank lies in one of
them, which is cut again in the next round, from its own least to its own greatest value. Once no range
holds more than SMALL values, or all of a range's are equal, the ranks are read off. Counts combine before
they shuffle, so a key may hold any share of the rows and no task keeps a key's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.session import staged, unstage

#: Ranges that a range is cut into, and values of a range that are sorted as they are.
CELLS, SMALL = 4096, 10_000
#: Copies of a key's ranges, so that a key's values can meet them in several tasks.
SALTS = 8
_MOST = 8e307  # half ranges of finite values stay finite


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & a[n].eqNullSafe(b[n])
    return on


def beside(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with the other columns of right, which has a row a key; null keys meet, and without keys the only rows."""
    other = right.select(F.lit(0).alias("_k"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    left = left.withColumn("_only", F.lit(0))
    on = F.col("_only") == F.col("_k")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return left.join(other, on, "left").drop("_only", "_k", *[f"_k{i}" for i in range(len(keys))])


def _ranks(at: dict[str, float], discrete: tuple[str, ...]) -> Column:
    ranks = []
    for name, p in at.items():
        if name in discrete:
            ranks.append(F.greatest(F.ceil(F.col("n") * p) - 1, F.lit(0)))
        else:
            ranks += [F.floor((F.col("n") - 1) * p), F.ceil((F.col("n") - 1) * p)]
    return F.array_distinct(F.array(*[r.cast("long") for r in ranks]))


def _within(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """values (keys, _v) that lie in a range (lo, hi) of targets, with that range."""
    spans = targets.groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # two a quantile at most
    spans = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = values.withColumn("salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int"))
    met = salted.join(spans, _same(salted, spans, [*keys, "salt"])).select(*[salted[k] for k in keys], "_v", F.expr("get(filter(spans, x -> _v between x.lo and x.hi), 0)").alias("s"))
    return met.filter(F.col("s").isNotNull()).select(*keys, "_v", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"))


def _narrowed(values: DataFrame, targets: DataFrame, keys: list[str], cells: int) -> DataFrame:
    """targets with the cell of their range that their rank lies in as range."""

    def half(c: str) -> Column:
        return F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), F.col(c))) / 2

    share = (half("_v") - half("lo")) / (half("hi") - half("lo"))
    # The ends have cells of their own, so every round tells some values apart.
    cell = F.when(F.col("_v") == F.col("lo"), -1).when(F.col("_v") == F.col("hi"), cells + 1).otherwise(F.floor(F.coalesce(share, F.lit(0.0)) * cells))
    counted = _within(values, targets, keys).groupBy(*keys, "lo", "hi", cell.alias("cell")).agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("least"), F.max("_v").alias("most"))
    before = Window.partitionBy(*keys, "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    on = _same(targets, counted, [*keys, "lo", "hi"]) & targets["left"].between(counted["before"], counted["before"] + counted["c"] - 1)
    return targets.join(counted, on).select(
        *[targets[k] for k in keys], "n", "rank", (F.col("left") - F.col("before")).alias("left"), F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("c").alias("size")
    )


def exact_quantiles(
    rows: DataFrame, keys: list[str], value: str, at: dict[str, float], discrete: tuple[str, ...] = (), cells: int = CELLS, small: int = SMALL
) -> DataFrame:
    """keys, n, and a column for each name of `at` with that quantile of value; one row without keys.

    Quantiles are interpolated between the two next ranks, but those in discrete are the least value with at
    least that share of all at or below it. Nulls don't count, and a key with nothing else has no row; NaN
    counts as infinite. A null key is a key.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    v = F.col(value).cast("double")
    values = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.when(F.isnan(v), float("inf")).otherwise(v).alias("_v"))
    values = values.filter(F.col("_v").isNotNull())
    if not keys:
        names, values = ["_k"], values.withColumn("_k", F.lit(0))
    whole = values.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    targets = whole.select(*names, "n", F.explode(_ranks(at, discrete)).alias("rank"), "lo", "hi")
    targets = staged(targets.select(*names, "n", "rank", F.col("rank").alias("left"), "lo", "hi", F.col("n").alias("size")), "ranks")
    wide = (F.col("lo") < F.col("hi")) & (F.col("size") > small)
    while not targets.filter(wide).isEmpty():
        after = staged(targets.filter(~wide).unionByName(_narrowed(values, targets.filter(wide), names, cells)), "ranks")
        unstage(targets)
        targets = after
    equal, rest = targets.filter("lo = hi"), targets.filter("lo < hi")
    place = F.row_number().over(Window.partitionBy(*names, "lo", "hi").orderBy("_v")) - 1
    sorted_ = _within(values, rest, names).withColumn("place", place)
    read = rest.join(sorted_, _same(rest, sorted_, [*names, "lo", "hi"]) & (rest["left"] == sorted_["place"])).select(*[rest[k] for k in names], "n", "rank", "_v")
    found = equal.select(*names, "n", "rank", F.col("lo").alias("_v")).unionByName(read)
    by_rank = found.groupBy(*names, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "_v"))).alias("by"))

    def of(name: str, p: float) -> Column:
        if name in discrete:
            return F.col("by")[F.greatest(F.ceil(F.col("n") * p) - 1, F.lit(0)).cast("long")]
        h = (F.col("n") - 1) * p
        low, high = F.col("by")[F.floor(h).cast("long")], F.col("by")[F.ceil(h).cast("long")]
        return F.when(low == high, low).otherwise(low * (1 - (h - F.floor(h))) + high * (h - F.floor(h)))

    return by_rank.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=False)], "n", *[of(n, p).alias(n) for n, p in at.items()])
