"""Greedy length-aware batches over any number of rows, without a fold over one task.

Rows stand in the order of (length, key). As lengths only grow, the batch that would start at a row ends at a
place that its next rows tell. Rows are cut into blocks; in each, the ends are followed from every place where
a batch from the block before may run over, which gives where that batch chain leaves the block. These jumps
from block to block are then joined by pointer doubling, so it takes the logarithm of the number of blocks to
know where the chain from the first row enters each block; a second pass over the blocks numbers the batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.session import bound_arrow_batches, staged, unstage

#: Rows of a block, at least; it also holds the rows that a batch may take from the next one.
BLOCK = 1 << 16
#: Leading digits of a hash that rows of equal length are counted by before they are numbered.
DIGITS = 4


def batch_ends(lengths: np.ndarray, max_tokens: int, max_batch_size: int) -> np.ndarray:
    """For each row of sorted lengths, the place after the last row of a batch that starts there.

    A batch of m rows fits if (its last length + 2) * m is within max_tokens; one row always does. What
    fits is a stretch from one row on, so its end is found by bisection, for all rows at once.
    """
    n = len(lengths)
    start = np.arange(n)
    low, high = np.ones(n, dtype=np.int64), np.minimum(max_batch_size, n - start)
    while (low < high).any():
        m = (low + high + 1) // 2
        fits = (lengths[start + m - 1] + 2) * m <= max_tokens
        low, high = np.where(fits, m, low), np.where(fits, high, m - 1)
    return start + low


def _on(a: list[str], b: list[str]):
    on = F.lit(True)
    for x, y in zip(a, b, strict=True):
        on = on & F.col(x).eqNullSafe(F.col(y))
    return on


def _numbered(rows: DataFrame, gs: list[str], hashed: bool) -> DataFrame:
    """rows (gs, _key, _len) with place, from 0 in the order of (_len, _key) within gs.

    Places are counted by length and, of hashes, by their first digits, so no task numbers all rows.
    """
    rows = rows.withColumn("_part", F.substring("_key", 1, DIGITS) if hashed else F.lit(""))
    counts = rows.groupBy(*gs, "_len", "_part").agg(F.count(F.lit(1)).alias("n"))
    lengths = counts.groupBy(*gs, "_len").agg(F.sum("n").alias("n"))

    def ahead(df: DataFrame, part: list[str], order: str) -> DataFrame:
        before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")

    keys = [*gs, "_len"]
    shorter = ahead(lengths, gs, "_len").select(*[F.col(k).alias(f"{k}x") for k in keys], F.col("ahead").alias("shorter"))
    earlier = ahead(counts, keys, "_part").join(shorter, _on(keys, [f"{k}x" for k in keys]))
    keys = [*keys, "_part"]
    earlier = earlier.select(*[F.col(k).alias(f"{k}y") for k in keys], (F.col("ahead") + F.col("shorter")).alias("first"))
    placed = rows.withColumn("_w", F.row_number().over(Window.partitionBy(*keys).orderBy("_key")) - 1)
    placed = placed.join(earlier.hint("merge"), _on(keys, [f"{k}y" for k in keys]))
    return placed.select(*gs, "_key", "_len", (F.col("first") + F.col("_w")).alias("place"))


def _chain(block: pa.Table, max_tokens: int, max_batch_size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The order of a block's rows by place, the batch ends of its own rows, and how many these are."""
    order = np.argsort(block.column("place").to_numpy(), kind="stable")
    lengths = block.column("_len").to_numpy()[order]
    own = int((~block.column("_next").to_numpy(zero_copy_only=False)).sum())
    return order, batch_ends(lengths, max_tokens, max_batch_size)[:own], own


def greedy_batches(
    rows: DataFrame, key: str, length: str, max_tokens: int, max_batch_size: int, group: list[str] | None = None, block: int = BLOCK
) -> DataFrame:
    """What batching.length_batches() gives, for any number of rows a group: group, key, length, batch_id, place.

    A batch closes before a row that would make it longer than max_batch_size or (length + 2) * rows larger
    than max_tokens; a row too long for any batch is one alone. Keys should be unique within a group, and
    spread if they are strings, as hashes are; rows of a null length are left out.
    """
    if max_tokens < 1 or max_batch_size < 1:
        raise ValueError("limits must be positive")
    spark, groups = rows.sparkSession, group or []
    bound_arrow_batches(spark)
    size = max(block, 2 * max_batch_size)
    gs = [f"_g{i}" for i in range(len(groups))] or ["_g0"]
    named = [F.col(c).alias(n) for c, n in zip(groups, gs, strict=False)] or [F.lit(0).alias("_g0")]
    kept = rows.select(*named, F.col(key).alias("_key"), F.col(length).cast("long").alias("_len")).filter(F.col("_len").isNotNull())
    placed = staged(_numbered(kept, gs, dict(kept.dtypes)["_key"] == "string"), "placed").withColumn("block", F.floor(F.col("place") / size))
    over = placed.filter((F.col("block") > 0) & (F.col("place") % size < max_batch_size - 1)).withColumn("block", F.col("block") - 1)
    blocks = placed.withColumn("_next", F.lit(False)).unionByName(over.withColumn("_next", F.lit(True)))
    gkind = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in gs)
    arrow = pa.schema([pa.field("entry", pa.int64()), pa.field("exit", pa.int64()), pa.field("batches", pa.int64())])

    def jumps(part: pa.Table) -> pa.Table:
        _, ends, own = _chain(part, max_tokens, max_batch_size)
        out, count = ends.tolist(), [1] * own
        for i in range(own - 1, -1, -1):
            if out[i] < own:
                count[i] += count[out[i]]
                out[i] = out[out[i]]
        entries = min(max_batch_size, own)
        # The last block has no rows after it, so its exit is the first place of none.
        found = pa.Table.from_arrays([pa.array(range(entries), pa.int64()), pa.array([x - own for x in out[:entries]], pa.int64()), pa.array(count[:entries], pa.int64())], schema=arrow)
        fixed = part.slice(0, 1).select([*gs, "block"]).take(pa.array([0] * entries))
        for n in arrow.names:
            fixed = fixed.append_column(n, found.column(n))
        return fixed

    kind = f"{gkind}, block long, entry long, exit long, batches long"
    each = staged(blocks.groupBy(*gs, "block").applyInArrow(jumps, kind), "jumps")
    last = each.agg(F.max("block")).first()[0] or 0
    # Where the chain from the first row enters each block: known for twice as many blocks after every round.
    reached = each.filter("block = 0 AND entry = 0").select(*gs, "block", "entry")
    step = each.select(*gs, "block", "entry", "exit", F.lit(1).cast("long").alias("far"))
    keys, span = [*gs, "block", "entry"], 1
    while span <= last:
        to = [F.col(k).alias(f"{k}t") for k in keys]
        moved = reached.join(step.select(*to, "exit", "far"), _on(keys, [f"{k}t" for k in keys])).select(*gs, (F.col("block") + F.col("far")).alias("block"), F.col("exit").alias("entry"))
        exists = each.select(*[F.col(g).alias(f"{g}b") for g in gs], F.col("block").alias("bb")).distinct()
        moved = moved.join(exists, _on([*gs, "block"], [*[f"{g}b" for g in gs], "bb"]), "left_semi")
        after = staged(reached.unionByName(moved), "reached")
        onward = step.select(*to, F.col("exit").alias("exit2"), F.col("far").alias("far2"))
        met = step.withColumn("at", F.col("block") + F.col("far")).join(onward, _on([*gs, "at", "exit"], [*[f"{g}t" for g in gs], "blockt", "entryt"]))
        further = staged(met.select(*gs, "block", "entry", F.col("exit2").alias("exit"), (F.col("far") + F.col("far2")).alias("far")), "step")
        if span > 1:
            unstage(reached), unstage(step)
        reached, step, span = after, further, 2 * span
    before = Window.partitionBy(*gs).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    to = [F.col(k).alias(f"{k}t") for k in keys]
    entered = reached.join(each.select(*to, "batches"), _on(keys, [f"{k}t" for k in keys])).select(*gs, "block", "entry", F.coalesce(F.sum("batches").over(before), F.lit(0)).alias("offset"))

    def number(part: pa.Table, entry: pa.Table) -> pa.Table:
        order, ends, own = _chain(part, max_tokens, max_batch_size)
        starts, at = np.zeros(own, dtype=np.int64), entry.column("entry")[0].as_py()
        while at < own:
            starts[at], at = 1, int(ends[at])
        ids = np.cumsum(starts) - 1 + entry.column("offset")[0].as_py()
        mine = part.take(pa.array(order)).filter(pa.array(np.arange(len(order)) < own))
        return mine.select([*gs, "_key", "_len", "place"]).append_column("batch_id", pa.array(ids))

    kind = f"{gkind}, _key {kept.schema['_key'].dataType.simpleString()}, _len long, place long, batch_id long"
    out = blocks.groupBy(*gs, "block").cogroup(entered.groupBy(*gs, "block")).applyInArrow(number, kind)
    names = [F.col(n).alias(c) for c, n in zip(groups, gs, strict=False)]
    return out.select(*names, F.col("_key").alias(key), F.col("_len").alias(length), F.col("batch_id").cast("int").alias("batch_id"), "place")
