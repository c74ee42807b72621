"""Exact medoids of groups of any size, by bounds on sums of distances.

Equal vectors of a group have equal sums: they are one member with a weight. The sum S of weighted distances
to all n vectors of a group is bounded from below at a member y by

* Hölder's inequality, S(y) >= (sum of d^2)^1.5 / (sum of d^4)^0.5, where both sums follow from the group's
  moments, without any distance;
* the tangents at members a whose sums are known, S(y) >= S(a) + S'(a) (y - a), as S is convex;
* the triangle inequality, S(y) >= n d(y, a) - S(a).

Whoever's bound passes the least sum so far is out. The members with the smallest bounds are measured next
against the whole group, GROWTH times as many in each round, until none is left. Distances come from matrix
products, and nearly equal vectors' from differences; the few members whose sums are least within the error of
that are measured once more, by differences alone. Where bounds prune little the work is quadratic in a group,
in tiles; no distance leaves its task, and only sums do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residua.session import bound_arrow_batches, shuffle_partitions, staged, unstage

#: Members of a group that are measured in the first round; each round takes GROWTH times as many as the last.
BLOCK, GROWTH = 64, 8
#: Rounds after which the measured members' tangents bound the others.
TANGENTS = 2
#: Groups of fewer members, and of longer vectors, aren't bounded by moments, which take the square of the length.
MOMENTS_FROM, MOMENTS_TO = 4096, 256
#: Members and numbers that are held together in a pack; packs of measured members in one task; pairs worth a task of their own.
PACK, NUMBERS, HELD, PAIRS = 1024, 1 << 16, 32, 1 << 24
#: Squares of distances below this share of the vectors' squares are taken from differences, as products lose their digits.
NEAR = 1e-5
#: Sums from products and bounds from them are right to this share; sums from differences to that one, and count as equal within it.
SLACK, EQUAL = 1e-8, 1e-14
_ERROR = 1e-10


def _matrix(rows: pa.Scalar) -> np.ndarray:
    """A list of lists of one length; of nulls, NaN."""
    rows = rows.values
    return np.asarray(rows.flatten().cast(pa.float64()).fill_null(np.nan), dtype=np.float64).reshape(len(rows), len(rows[0]) if len(rows) else 0)


def _vector(row: pa.Scalar) -> np.ndarray:
    return np.asarray(row.values, dtype=np.float64)


@np.errstate(all="ignore")
def _differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of a and b."""
    return np.stack([np.sqrt(((b - x) ** 2).sum(axis=1)) for x in a])


class _Products:
    """Distances by products of matrices; middle: what vectors are taken from first, to keep digits."""

    def __init__(self, middle: np.ndarray):
        self.middle = middle

    @np.errstate(all="ignore")
    def left(self, a: np.ndarray) -> tuple:
        c = a - self.middle
        n = (c * c).sum(axis=1)
        return a, n, np.column_stack([-2 * c, n, np.ones(len(c))])

    @np.errstate(all="ignore")
    def right(self, b: np.ndarray) -> tuple:
        c = b - self.middle
        n = (c * c).sum(axis=1)
        return b, n, np.column_stack([c, np.ones(len(c)), n]).T

    def distances(self, left: tuple, right: tuple) -> np.ndarray:
        (a, na, p), (b, nb, q) = left, right
        most = na.max() + nb.max()
        if not 1e-280 < most < 1e280:
            return _differences(a, b)
        t = p @ q
        if t.min() < NEAR * most:
            i, j = np.nonzero(t < NEAR * (na[:, None] + nb))
            if len(i) > t.size // 16:
                return _differences(a, b)
            for k in range(0, len(i), 4096):
                x, y = i[k : k + 4096], j[k : k + 4096]
                t[x, y] = ((a[x] - b[y]) ** 2).sum(axis=1)
        return np.sqrt(t, out=t)


class _Sums:
    """Sums of the distances from a cell's measured members to its packs'; with slopes, the gradients of these sums too."""

    def __init__(self, exact: bool = False, slopes: bool = False):
        self.exact, self.slopes, self.pieces, self.products = exact, slopes, [], None

    def piece(self, at: int, x: pa.Scalar, v: pa.Scalar) -> None:
        a = _matrix(x)
        self.products = self.products or _Products(np.nan_to_num(np.median(a[:: max(1, len(a) // 64)], axis=0), posinf=0.0, neginf=0.0))
        tiles = [self.products.left(a[k : k + 256]) for k in range(0, len(a), 256)]
        self.pieces.append((at, tiles, np.zeros(len(a)), np.zeros(a.shape) if self.slopes else None))

    @np.errstate(all="ignore")
    def pack(self, keys: pa.Array, w: pa.Scalar, x: pa.Scalar) -> Iterator[list]:
        w, right = _vector(w), self.products.right(_matrix(x))
        for _, tiles, sums, slopes in self.pieces:
            k = 0
            for left in tiles:
                d, here = _differences(left[0], right[0]) if self.exact else self.products.distances(left, right), slice(k, k + len(left[0]))
                sums[here] += d @ w
                if slopes is not None:
                    u = np.divide(w, d, out=np.zeros_like(d), where=d > SLACK * np.sqrt(left[1])[:, None])
                    slopes[here] += u.sum(axis=1)[:, None] * (left[0] - self.products.middle) - u @ right[2][: right[0].shape[1]].T
                k += len(left[0])
        return iter(())

    def end(self) -> Iterator[list]:
        for at, _, sums, slopes in self.pieces:
            yield [pa.array([at], pa.int32()), pa.array([sums if slopes is None else np.concatenate([sums, slopes.ravel()])], pa.list_(pa.float64()))]


class _Moments:
    """A group's moments about a point, as one row of numbers: the point, weights, squares, fourth powers, the rest."""

    def __init__(self):
        self.middle, self.sums = None, 0.0

    def piece(self, at: int, x: pa.Scalar, v: pa.Scalar) -> None:
        self.middle = _vector(v)

    def pack(self, keys: pa.Array, w: pa.Scalar, x: pa.Scalar) -> Iterator[list]:
        w, c = _vector(w), _matrix(x) - self.middle
        n = (c * c).sum(axis=1)
        self.sums = self.sums + np.concatenate([[w.sum(), w @ n, w @ (n * n)], w @ c, (w * n) @ c, ((c.T * w) @ c).ravel()])
        return iter(())

    def end(self) -> Iterator[list]:
        if self.middle is not None and np.ndim(self.sums):
            yield [pa.array([0], pa.int32()), pa.array([self.sums], pa.list_(pa.float64()))]


def _bounded(keys: pa.Array, bound: np.ndarray) -> list:
    return [keys, pa.array([np.where(np.isfinite(bound), bound, 0.0)], pa.list_(pa.float64()))]


class _ByMoments:
    """Bounds by Hölder's inequality. A piece: the point and the moments about it."""

    def piece(self, at: int, x: pa.Scalar, v: pa.Scalar) -> None:
        v = _vector(v)
        d = int(v[0])
        self.middle, (self.w, self.n1, self.n2), rest = v[1 : d + 1], v[d + 1 : d + 4], v[d + 4 :]
        self.c, self.nc, self.cc = rest[:d], rest[d : 2 * d], rest[2 * d :].reshape(d, d)

    def pack(self, keys: pa.Array, w: pa.Scalar, x: pa.Scalar) -> Iterator[list]:
        y = _matrix(x) - self.middle
        n, c = (y * y).sum(axis=1), y @ self.c
        squares = self.w * n + self.n1 - 2 * c - _ERROR * (self.w * n + self.n1)
        fourths = self.w * n * n + self.n2 + 4 * ((y @ self.cc) * y).sum(axis=1) + 2 * n * self.n1 - 4 * n * c - 4 * (y @ self.nc)
        fourths += _ERROR * (self.w * n * n + self.n2 + 2 * n * self.n1)
        with np.errstate(all="ignore"):
            yield _bounded(keys, np.where(squares > 0, squares * np.sqrt(squares / fourths), 0.0))

    def end(self) -> Iterator[list]:
        return iter(())


class _ByTangents:
    """Bounds by members whose sums and slopes are known. A piece: n, these members, their sums and slopes."""

    def __init__(self):
        self.pieces = []

    def piece(self, at: int, x: pa.Scalar, v: pa.Scalar) -> None:
        a, v = _matrix(x), _vector(v)
        products, slopes = _Products(a[0]), v[1 + len(a) :].reshape(a.shape)
        sums = v[1 : 1 + len(a)]
        far = np.sqrt(((a - a[0]) ** 2).sum(axis=1)).max()
        self.pieces.append((v[0], products, products.left(a), sums, slopes, sums - (slopes * (a - a[0])).sum(axis=1), far))

    def pack(self, keys: pa.Array, w: pa.Scalar, x: pa.Scalar) -> Iterator[list]:
        m = _matrix(x)
        bound = np.zeros(len(m))
        with np.errstate(all="ignore"):
            for n, products, left, sums, slopes, start, far in self.pieces:
                right = products.right(m)
                slack = 10 * SLACK * (sums.max() + n * (far + np.sqrt(right[1])))
                tangents = ((m - products.middle) @ slopes.T + start).max(axis=1)
                bound = np.fmax(bound, np.maximum(tangents, (n * products.distances(left, right) - sums[:, None]).max(axis=0)) - slack)
        yield _bounded(keys, bound)

    def end(self) -> Iterator[list]:
        return iter(())


def _by_cell(work: Callable, names: list[str]) -> Callable:
    """For rows of _dealt(): one object of work for each cell, given first its pieces and then its packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, of, g = None, None, None
        for batch in batches:
            group, r, c, kind, at, keys, w, x, v = batch.columns
            for row in range(batch.num_rows):
                now = repr((group[row].as_py(), r[row].as_py(), c[row].as_py()))
                if now != cell:
                    if of is not None:
                        for out in of.end():
                            yield pa.RecordBatch.from_arrays([g, *out], names=names)
                    cell, of, g = now, work(), group.slice(row, 1)
                if kind[row].as_py() == 0:
                    of.piece(at[row].as_py(), x[row], v[row])
                else:
                    for out in of.pack(keys.slice(row, 1), w[row], x[row]):
                        yield pa.RecordBatch.from_arrays([g, *out], names=names)
        if of is not None:
            for out in of.end():
                yield pa.RecordBatch.from_arrays([g, *out], names=names)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, at, v) in order: the sum of v for each group and at."""
    cell, total, first = None, None, None
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            now, v = repr((one.column(0)[0].as_py(), one.column(1)[0].as_py())), _vector(one.column(2)[0])
            if now == cell:
                total = total + v
                continue
            if first is not None:
                yield pa.RecordBatch.from_arrays([*first, pa.array([total], pa.list_(pa.float64()))], names=["_g", "_at", "v"])
            cell, total, first = now, v, one.columns[:2]
    if first is not None:
        yield pa.RecordBatch.from_arrays([*first, pa.array([total], pa.list_(pa.float64()))], names=["_g", "_at", "v"])


def _dealt(packs: DataFrame, pieces: DataFrame, plan: DataFrame, parts: int) -> DataFrame:
    """Each pack with each piece of its group, in one of the plan's rows x columns cells; a cell's pieces come before its packs."""
    null = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in [*packs.schema, *pieces.schema]}
    there = packs.join(plan, "_g").select(
        "_g", F.pmod("_p", "_rows").cast("int").alias("_r"), F.explode(F.sequence(F.lit(0), F.col("_columns") - 1)).alias("_c"), F.lit(1).alias("_kind"), F.col("_p").alias("_at"), "keys", "w", "x", null["v"]
    )
    here = pieces.join(plan, "_g").select(
        "_g", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("_r"), F.pmod("_at", "_columns").cast("int").alias("_c"), F.lit(0).alias("_kind"), "_at", null["keys"], null["w"], "x", "v"
    )
    return here.unionByName(there).repartition(parts, "_g", "_r", "_c").sortWithinPartitions("_g", "_r", "_c", "_kind", "_at")


def exact_medoid(vectors: DataFrame, group: str, key: str, column: str, block: int = BLOCK, most_rounds: int = 10_000) -> DataFrame:
    """group, key, total_distance, measured: each group's member with the least sum of distances to the others.

    Equal sums (within floating error) go to the smaller key. measured is how many unlike vectors were
    measured against the group. Rows with a null vector are left out; a null group is a group; keys must be unique
    in it, and its vectors of one length.
    """
    spark = vectors.sparkSession
    bound_arrow_batches(spark)
    tasks = shuffle_partitions(spark)
    element = getattr(vectors.schema[column].dataType, "elementType", None)
    numbers = F.col(column) if isinstance(element, T.FloatType) else F.col(column).cast("array<double>")
    rows = vectors.select(F.struct(F.col(group).alias("k")).alias("_g"), F.struct(F.col(key).alias("k")).alias("_key"), numbers.alias("x"))
    rows = rows.filter(F.col("x").isNotNull())
    distinct = staged(rows.groupBy("_g", "x").agg(F.min("_key").alias("_key"), F.count(F.lit(1)).alias("w")), "medoid")
    sizes = distinct.groupBy("_g").agg(F.count(F.lit(1)).alias("m"), F.sum("w").alias("n"), F.max(F.size("x")).alias("d"), F.min(F.size("x")).alias("_least"))
    one_length = F.when(F.col("d") == F.col("_least"), F.col("d")).otherwise(F.raise_error(F.lit("vectors of unlike length in a group")).cast("int"))
    sizes = sizes.select("_g", "m", "n", one_length.alias("d"))
    per = F.greatest(F.lit(16), F.least(F.lit(PACK), F.floor(NUMBERS / F.greatest("d", F.lit(1))))).cast("int")
    groups = staged(sizes.withColumn("_per", per).withColumn("_packs", F.ceil(F.col("m") / F.col("_per")).cast("int")), "medoid-groups")
    most, cells = groups.agg(F.coalesce(F.max("m"), F.lit(0)), F.coalesce(F.sum(F.col("_packs") + F.ceil(F.col("m") * F.col("m") / PAIRS)), F.lit(1))).first()
    parts = min(4 * tasks, int(cells))
    part = F.pmod(F.xxhash64(F.lit("pack"), "_key"), F.col("_packs")).cast("int").alias("_p")
    packs = distinct.join(groups, "_g").groupBy("_g", part).agg(F.array_sort(F.collect_list(F.struct("_key", "w", "x"))).alias("c"))
    packs = staged(packs.select("_g", "_p", F.col("c._key").alias("keys"), F.col("c.w").alias("w"), F.col("c.x").alias("x")), "medoid-packs")

    of = {name: packs.schema[name].dataType.simpleString() for name in ("_g", "keys", "x")}
    vector = F.lit(None).cast("array<double>").alias("v")
    rows_of_packs = F.least(F.lit(2 * tasks), F.col("_packs")).cast("int").alias("_rows")

    def summed(pieces: DataFrame, plan: DataFrame, work: Callable) -> DataFrame:
        out = _dealt(packs, pieces, plan, parts).mapInArrow(_by_cell(work, ["_g", "_at", "v"]), f"_g {of['_g']}, _at int, v array<double>")
        return out.repartition(tasks, "_g", "_at").sortWithinPartitions("_g", "_at").mapInArrow(_added, f"_g {of['_g']}, _at int, v array<double>")

    def bounds(pieces: DataFrame, plan: DataFrame, work: Callable) -> DataFrame:
        out = _dealt(packs, pieces, plan, parts).mapInArrow(_by_cell(work, ["_g", "keys", "b"]), f"_g {of['_g']}, keys {of['keys']}, b array<double>")
        return out.select("_g", F.inline(F.arrays_zip("keys", "b"))).withColumnRenamed("keys", "_key")

    def pieces_of(some: DataFrame, name: str) -> DataFrame:
        """Members (_g, _key, _r from 1) with their vectors, in packs."""
        some = some.join(groups.select("_g", "_per"), "_g").select("_g", "_key", F.floor((F.col("_r") - 1) / F.col("_per")).cast("int").alias("_at"))
        some = some.join(distinct.select("_g", "_key", "x"), ["_g", "_key"]).groupBy("_g", "_at").agg(F.array_sort(F.collect_list(F.struct("_key", "x"))).alias("c"))
        return staged(some.select("_g", "_at", F.col("c._key").alias("keys"), F.col("c.x").alias("x")), name)

    def plan_of(pieces: DataFrame) -> DataFrame:
        """As many cells as there is work for, nearly square, with few enough pieces in each."""
        plan = pieces.groupBy("_g").agg(F.count(F.lit(1)).alias("_pieces"), F.sum(F.size("keys")).alias("q")).join(groups, "_g")
        cells = F.least(F.lit(2 * tasks), F.ceil(F.col("m") * F.col("q") / PAIRS))
        columns = F.least("_pieces", F.greatest(F.floor(F.sqrt(cells)), F.ceil(F.col("_pieces") / HELD), F.lit(1))).cast("int")
        plan = plan.withColumn("_columns", columns).withColumn("_rows", F.least("_packs", F.ceil(cells / F.col("_columns"))).cast("int"))
        return staged(plan.select("_g", "m", "n", "q", "_rows", "_columns", rows_of_packs.alias("_all_rows")), "medoid-plan")

    def measured(pieces: DataFrame, sums: DataFrame) -> DataFrame:
        total = F.slice("v", F.lit(1), F.size("keys")).alias("total")
        return pieces.join(sums, ["_g", "_at"]).select("_g", "keys", total).select("_g", F.inline(F.arrays_zip("keys", "total"))).withColumnRenamed("keys", "_key")

    def numbered(some: DataFrame, over: int, count: int | None = None) -> DataFrame:
        """_r from 1 within a group, without a gap: by parts, and in these by bound; with a count, so many of a group at most, or little more."""
        some = some.withColumn("_p", F.pmod(F.xxhash64("_key"), F.lit(over))).repartition(tasks, "_g", "_p")
        some = some.withColumn("_r", F.row_number().over(Window.partitionBy("_g", "_p").orderBy("bound", F.xxhash64("_key"), "_key")))
        some = some if count is None else some.filter(F.col("_r") <= math.ceil(count / over))
        before = F.coalesce(F.sum("_n").over(Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = some.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_n")).select("_g", "_p", before.alias("_before"))
        return some.join(parts, ["_g", "_p"]).select("_g", "_key", (F.col("_r") + F.col("_before")).alias("_r"))

    state = distinct.select("_g", "_key", F.lit(0.0).alias("bound"), F.lit(None).cast("double").alias("total"))
    if most >= MOMENTS_FROM:
        plan = groups.filter((F.col("m") >= MOMENTS_FROM) & (F.col("d") <= MOMENTS_TO)).select("_g", rows_of_packs, F.lit(1).alias("_columns"))
        # Moments are about the mean of a pack, near which no digits are lost; any point would do.
        middle = packs.filter("_p = 0").join(plan, "_g").select("_g", F.posexplode(F.col("x")).alias("_i", "x")).select("_g", F.posexplode("x").alias("_i", "e"))
        middle = middle.groupBy("_g", "_i").agg(F.avg("e").alias("e")).groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_i", "e"))).alias("v"))
        middle = staged(middle.select("_g", F.lit(0).alias("_at"), F.lit(None).cast(of["x"]).alias("x"), F.col("v.e").alias("v")), "medoid-middle")
        moments = summed(middle, plan, _Moments).join(middle.select("_g", F.col("v").alias("_middle")), "_g")
        about = F.concat(F.array(F.size("_middle").cast("double")), "_middle", "v").alias("v")
        moments = staged(moments.select("_g", "_at", F.lit(None).cast(of["x"]).alias("x"), about), "medoid-moments")
        state = state.drop("bound").join(bounds(moments, plan, _ByMoments), ["_g", "_key"], "left")
        state = state.select("_g", "_key", F.coalesce("b", F.lit(0.0)).alias("bound"), "total")
        state, old = staged(state, "medoid-state"), [middle, moments]
        for x in old:
            unstage(x)

    own = most >= MOMENTS_FROM
    for r in range(most_rounds):
        count = min(block * GROWTH**r, 1 << 40)
        best = state.groupBy("_g").agg(F.min("total").alias("best"))
        open_ = state.filter(F.col("total").isNull()).join(best, "_g").filter(F.col("best").isNull() | (F.col("bound") <= F.col("best") * (1 + 2 * SLACK)))
        # The first members of many parts of a group, as parts are alike; at last, all.
        some = numbered(open_, max(1, min(tasks, count // 8)), count if count < most else None)
        chosen = pieces_of(some, "medoid-block")
        plan = plan_of(chosen)
        if plan.isEmpty():
            unstage(chosen)
            unstage(plan)
            break
        slopes = r < TANGENTS and count < most
        sums = staged(summed(chosen.select("_g", "_at", "x", vector), plan, lambda slopes=slopes: _Sums(slopes=slopes)), "medoid-sums")
        after = state.join(measured(chosen, sums).withColumnRenamed("total", "_new"), ["_g", "_key"], "left")
        after = after.select("_g", "_key", "bound", F.coalesce("total", "_new").alias("total"))
        if slopes:
            rest = plan.filter(F.col("q") < F.col("m")).select("_g", "n", F.col("_all_rows").alias("_rows"), F.lit(1).alias("_columns"))
            known = chosen.join(sums, ["_g", "_at"]).join(rest.select("_g", "n"), "_g")
            known = known.select("_g", "_at", "x", F.concat(F.array(F.col("n").cast("double")), "v").alias("v"))
            after = after.join(bounds(known, rest.drop("n"), _ByTangents), ["_g", "_key"], "left")
            after = after.select("_g", "_key", F.greatest("bound", F.coalesce("b", F.lit(0.0))).alias("bound"), "total")
        after = staged(after, "medoid-state")
        for x in (chosen, plan, sums, *[state] * own):
            unstage(x)
        state, own = after, True
        if count >= most:
            break
    else:
        raise RuntimeError("medoids did not settle")

    # Of sums that aren't finite none needs to be told from the others.
    least = state.groupBy("_g").agg(F.min(F.when(F.col("total").isNotNull(), F.struct("total", "_key"))).alias("first"), F.count("total").alias("measured"))
    best = F.col("first.total")
    last = state.join(least, "_g").filter((F.col("total") <= best * (1 + 3 * SLACK)) & ((best < float("inf")) | (F.col("_key") == F.col("first._key"))))
    last = numbered(last, tasks)
    chosen = pieces_of(last, "medoid-last")
    plan = plan_of(chosen)
    sums = staged(summed(chosen.select("_g", "_at", "x", vector), plan, lambda: _Sums(exact=True)), "medoid-sums")
    totals = staged(measured(chosen, sums), "medoid-totals")
    best = totals.groupBy("_g").agg(F.min("total").alias("best"))
    equal = totals.join(best, "_g").filter(F.col("total") <= F.col("best") * (1 + EQUAL)).groupBy("_g").agg(F.min(F.struct("_key", "total")).alias("r"))
    out = staged(equal.join(least.select("_g", "measured"), "_g"), "medoid-least")
    for x in (distinct, groups, packs, chosen, plan, sums, totals, *[state] * own):
        unstage(x)
    return out.select(F.col("_g.k").alias(group), F.col("r._key.k").alias(key), F.col("r.total").alias("total_distance"), "measured")
