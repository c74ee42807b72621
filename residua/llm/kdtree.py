"""Exact top-k search by inner product with KD-trees, one a shard.

Vectors are dealt into shards, and each shard becomes a KD-tree: median splits along the widest side, and
around every node the tightest box that holds its vectors. The inner product of a query with any vector
of a box is at most the sum over components of the larger of query times low end and query times high
end. Nodes are visited best bound first, and a query leaves a shard once no box can beat its kth score.

Queries travel in blocks. A block first searches one shard for its kth scores; these go with it to all
others, where they cut off boxes from the start. So a shard answers with what may still be in the top k,
not with k rows a query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.session import bound_arrow_batches, staged, unstage

SCALE = 64
K = 20
QUERY_EVERY = 20
#: Vectors of a shard and queries of a block, about.
SHARD, BLOCK = 8192, 256
#: Blocks that one copy of a shard serves.
BLOCKS_A_TASK = 16
#: Vectors of a leaf, at most.
LEAF = 512
#: Stands for a score that is no more than this, and for a kth score that isn't known.
LOWEST = -(1 << 63)


def number_type(bound: int) -> type:
    """The fastest type that holds all sums of products exactly that don't exceed bound."""
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def largest(values: np.ndarray) -> int:
    """The largest absolute value, also where that is no 64-bit integer."""
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


class Tree:
    """A KD-tree over integer vectors: boxes of all nodes, and the rows of each leaf."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        rows = np.arange(len(ids))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.span: list[tuple[int, int]] = []
        order = np.empty(len(ids), dtype=np.int64)
        rest = [(rows, 0, -1, 0)]
        while rest:
            mine, begin, parent, side = rest.pop()
            node = len(self.low)
            low, high = vectors[mine].min(axis=0), vectors[mine].max(axis=0)
            self.low.append(low), self.high.append(high)
            self.children.append(None), self.span.append((begin, begin + len(mine)))
            if parent >= 0:
                pair = list(self.children[parent] or (0, 0))
                pair[side] = node
                self.children[parent] = (pair[0], pair[1])
            axis = int(np.argmax(high.astype(np.float64) - low))
            if len(mine) <= leaf or high[axis] == low[axis]:
                order[begin : begin + len(mine)] = mine
                continue
            half = len(mine) // 2
            split = np.argpartition(vectors[mine, axis], half)
            rest.append((mine[split[half:]], begin + half, node, 1))
            rest.append((mine[split[:half]], begin, node, 0))
        self.exact, self.ids, self.most = vectors[order], ids[order], largest(vectors)
        self.of(np.float32)

    def of(self, kind: type) -> None:
        """Go on in numbers of that type."""
        if getattr(self, "kind", None) is not kind:
            self.kind, self.vectors = kind, self.exact.astype(kind)
            self.boxes = np.stack(self.low).astype(kind), np.stack(self.high).astype(kind)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, what no inner product within the node's box exceeds. Exact on integers."""
        low, high = self.boxes
        return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and scores, of at least floor and other than its own, that may be its top k here. Exact."""
        self.of(number_type(self.most * largest(queries) * queries.shape[1]))
        queries = queries.astype(self.kind)
        bound = self.bounds(queries)
        out = []
        for q in range(len(queries)):
            at_least, ids, scores = int(floor[q]) if floor[q] > LOWEST else -np.inf, [np.empty(0, np.int64)], [np.empty(0, self.kind)]
            heap = [(-bound[q, 0], 0)]
            while heap:
                reach, node = heapq.heappop(heap)
                if -reach < at_least:
                    break
                if (pair := self.children[node]) is not None:
                    for child in pair:
                        if bound[q, child] >= at_least:
                            heapq.heappush(heap, (-bound[q, child], child))
                    continue
                begin, end = self.span[node]
                score = self.vectors[begin:end] @ queries[q]
                good = np.flatnonzero((score >= at_least) & (self.ids[begin:end] != own[q]))
                if len(good):
                    ids.append(self.ids[begin + good])
                    scores.append(score[good])
                    have = np.concatenate(scores)
                    if len(have) > k:  # only scores of at least the kth stay, ties with it included
                        kth = np.sort(have)[-k] if self.kind is object else np.partition(have, len(have) - k)[len(have) - k]
                        at_least = max(at_least, int(kth))
                        keep = have >= at_least
                        ids, scores = [np.concatenate(ids)[keep]], [have[keep]]
            i, s = np.concatenate(ids), np.concatenate(scores)
            if len(i) > k:
                best = np.lexsort((i, -s))[:k]
                i, s = i[best], s[best]
            out.append((i, s))
        return out


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and code, the array of floor(scale * x); rows that take no part are gone.

    No part take null vectors, null ids, empty vectors, and vectors with a null or non-finite component.
    Raises when read if a component times scale is no 64-bit integer.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("x") > 0) & finite)
    fits = F.forall("x", lambda v: F.abs(v * scale) < float(1 << 63))
    checked = F.when(fits, F.col("x")).otherwise(F.raise_error(F.lit("a component is too large for a 64-bit integer")))
    return rows.select("vec_id", F.transform(checked, lambda v: F.floor(v * scale).cast("long")).alias("code"))


def _packed(rows: DataFrame, group: str, out: str) -> DataFrame:
    """A row per group: its ids and vectors as bytes. Groups are bounded by how rows are dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, codes = None, [], []

        def row() -> Iterator[pa.RecordBatch]:
            if ids:
                width = max(map(len, codes))
                data = np.zeros((len(ids), width), dtype=np.int64)
                for k, c in enumerate(codes):
                    data[k, : len(c)] = c
                if largest(data) < 1 << 31:
                    data = data.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.int64()), pa.array([width], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary())],
                    names=[out, "width", "ids", "data"],
                )

        for batch in batches:
            for g, i, c in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if g != key:
                    yield from row()
                    key, ids, codes = g, [], []
                ids.append(i), codes.append(c)
        yield from row()

    dealt = rows.repartition(group).sortWithinPartitions(group, "vec_id")
    return dealt.select(group, "vec_id", "code").mapInArrow(run, f"{out} long, width long, ids binary, data binary")


def _unpacked(width: int, ids: bytes, data: bytes, to: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype=np.int64)
    kind = np.int32 if len(data) == 4 * width * len(i) else np.int64
    v = np.frombuffer(data, dtype=kind).reshape(len(i), width).astype(np.int64)
    return i, np.pad(v, ((0, 0), (0, to - width))) if to > width else v


def _as_long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; what is too small for one becomes LOWEST, and what is too large raises."""
    if scores.dtype == object:
        if len(scores) and max(scores) >= 1 << 63:
            raise OverflowError("a score is too large for a 64-bit integer")
        return np.array([max(LOWEST, int(x)) for x in scores], dtype=np.int64)
    return (np.rint(scores) if scores.dtype.kind == "f" else scores).astype(np.int64)


def _search(held: DataFrame, asked: DataFrame, copies: int, k: int) -> DataFrame:
    """Search the shard of every row of asked: query_id, vec_id, score.

    held: shard, width, ids, data. asked: shard, block, width, ids, data, floor (bytes of a score a query,
    or null). Each shard goes to `copies` tasks, which share its blocks; there it comes first, its tree is
    built once, and the blocks pass by.
    """
    columns = ["shard", "copy", "kind", "width", "ids", "data", "floor"]
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    trees = held.select("shard", copy, F.lit(0).alias("kind"), "width", "ids", "data", F.lit(None).cast("binary").alias("floor"))
    blocks = asked.select("shard", F.pmod("block", F.lit(copies)).cast("int").alias("copy"), F.lit(1).alias("kind"), "width", "ids", "data", "floor")
    dealt = trees.unionByName(blocks).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind").select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, tree, built = None, None, 0
        for batch in batches:
            for kind, width, ids, data, floor in zip(*(batch.column(c).to_pylist() for c in range(2, 7)), strict=True):
                if kind == 0:
                    raw, tree = (width, ids, data), None
                    continue
                to = max(width, raw[0])
                own, queries = _unpacked(width, ids, data, to)
                if tree is None or built != to:
                    i, v = _unpacked(*raw, to)
                    tree, built = Tree(v, i), to
                least = np.full(len(own), LOWEST) if floor is None else np.frombuffer(floor, dtype=np.int64)
                found = tree.search(queries, own, k, least)
                n = [len(i) for i, _ in found]
                scores = _as_long(np.concatenate([s for _, s in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, n)), pa.array(np.concatenate([i for i, _ in found])), pa.array(scores)],
                    names=["query_id", "vec_id", "score"],
                )

    return dealt.mapInArrow(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """The k vectors of largest inner product for every row whose vec_id is divisible by query_every, in the shared folder.

    vectors: vec_id, embedding. Components become floor(scale * x). Returns query_id, rank (from 1),
    vec_id, score; ties go to the smaller vec_id; a query is no candidate of itself; fewer rows where
    there are fewer candidates. Vectors that are null or empty, or that hold null or non-finite
    components, take no part, nor do null ids. A shorter vector counts as padded with zeros. Rows that repeat
    a vec_id are one vector, the largest by components. An empty table gives no rows; other columns are
    ignored. Scores are exact however large the components are; where a result is no 64-bit integer above
    LOWEST, an error is raised. The caller may unstage() the result.
    """
    bound_arrow_batches(vectors.sparkSession)
    rows = quantized(vectors, scale).groupBy("vec_id").agg(F.max("code").alias("code"))
    rows = staged(rows, "vectors")
    is_query = F.pmod("vec_id", F.lit(query_every)) == 0
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    shards, blocks = max(1, -(-counts.n // SHARD)), max(1, -(-counts.q // BLOCK))
    key = F.xxhash64("vec_id")
    held = staged(_packed(rows.withColumn("g", F.pmod(key, F.lit(shards))), "g", "shard"), "shards")
    asked = _packed(rows.filter(is_query).withColumn("g", F.pmod(key, F.lit(blocks))), "g", "block")
    asked = staged(asked, "blocks")
    # One shard of each block's own gives a first kth score.
    home = F.pmod("block", F.lit(shards))
    first = asked.withColumn("shard", home).withColumn("floor", F.lit(None).cast("binary"))
    seen = staged(_search(held, first, 1, k), "first")
    kth = _best(seen, k).filter(F.col("rank") == k).select("query_id", "score")
    # Then all other shards, with these scores to start from.
    others = F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))
    rest = _floors(kth, asked, blocks).withColumn("shard", F.explode(others)).filter(F.col("shard") != home)
    found = seen.unionByName(_search(held, rest, max(1, -(-blocks // BLOCKS_A_TASK)), k))
    score = F.when(F.col("score") > F.lit(LOWEST), F.col("score")).otherwise(F.raise_error(F.lit("a score is too small for a 64-bit integer")))
    best = _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
    out = staged(best, "top_k")
    for table in (rows, held, asked, seen):
        unstage(table)
    return out


def _floors(kth: DataFrame, asked: DataFrame, blocks: int) -> DataFrame:
    """asked with floor: the known kth score of each query of the block, in order, LOWEST without one."""
    listed = kth.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("query_id", "score")).alias("kth")  # a block's queries: bounded
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, kth_of in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
                known = {x["query_id"]: x["score"] for x in kth_of or []}
                out.append(np.array([known.get(i, LOWEST) for i in np.frombuffer(ids, np.int64).tolist()], dtype=np.int64).tobytes())
            columns = [batch.column(c) for c in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=["block", "width", "ids", "data", "floor"])

    joined = asked.join(listed, "block", "left").select("block", "width", "ids", "data", "kth")
    return joined.mapInArrow(run, "block long, width long, ids binary, data binary, floor binary")


def oracle_sql(k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE) -> str:
    """top_k(embeddings) in DuckDB: every query against every row."""
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS code FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.code, c.code), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {query_every} = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {k}"""
