"""Shards, length-aware batches and stratified samples, all in a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one fold takes without a group, at most.
MOST_ROWS = 100_000


def number_rows(df: DataFrame, key: str, salt: str = "") -> DataFrame:
    """df with `position`, its 0-based place in the order of a column of hex hashes.

    The first four hex digits cut the order into ranges that are counted first, so no task sorts the
    whole table. Keys should be unique; equal ones are numbered in any order.
    """
    ranged = df.withColumn("_range", F.substring(key, 1, 4))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))  # 65,536 rows at most
    within = Window.partitionBy("_range").orderBy(key)
    placed = ranged.join(F.broadcast(offsets), "_range")
    return placed.withColumn("position", F.col("_offset") + F.row_number().over(within) - 1).drop("_range", "_offset")


def assign_shards(df: DataFrame, key: str = "sequence_hash", size: int = 2000) -> DataFrame:
    """df with shard_id, numbers of `size` rows each in the order of the hash."""
    if size < 1:
        raise ValueError("the shard size must be positive")
    return number_rows(df, key).withColumn("shard_id", F.floor(F.col("position") / size).cast("int"))


def shard_manifest(sharded: DataFrame, key: str = "sequence_hash") -> DataFrame:
    """Row count, first and last hash, and a hash of the contents of each shard."""
    out = sharded.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(key).alias("first_sequence_hash"),
        F.max(key).alias("last_sequence_hash"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(key)), "\n"), 256).alias("content_sha256"),  # a shard is bounded
    )
    return out.withColumn("filename", F.format_string("sequence_shard_%04d.parquet", "shard_id"))


def length_batches(rows: DataFrame, key: str, length: str, max_tokens: int, max_batch_size: int, group: list[str] | None = None) -> DataFrame:
    """Greedy batches over rows sorted by (length, key): key, length, batch_id, place.

    A batch closes before a row that would make it longer than max_batch_size or (length + 2) * rows
    larger than max_tokens; a row too long for any batch is one alone. The fold is sequential in each
    group, which one task holds: shards are bounded, so they are what to group by. Without a group all rows
    are one, and more than MOST_ROWS of them raise; greedy.greedy_batches() takes any number.
    """
    if max_tokens < 1 or max_batch_size < 1:
        raise ValueError("limits must be positive")
    groups = group or []
    if not groups and rows.limit(MOST_ROWS + 1).count() > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows without a group; give the columns of a bounded one")
    listed = rows.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct(F.col(length).cast("long").alias("length"), F.col(key).alias("key")))).alias("r"))
    kind = rows.schema[key].dataType.simpleString()
    # State: batch number, rows in the batch, and what has been dealt out.
    fold = f"""aggregate(r,
        named_struct('b', -1, 'n', 0, 'out', cast(array() as array<struct<length:bigint,key:{kind},b:int>>)),
        (s, x) -> if(s.b < 0 or s.n >= {max_batch_size} or (x.length + 2) * (s.n + 1) > {max_tokens},
            named_struct('b', s.b + 1, 'n', 1, 'out', concat(s.out, array(named_struct('length', x.length, 'key', x.key, 'b', s.b + 1)))),
            named_struct('b', s.b, 'n', s.n + 1, 'out', concat(s.out, array(named_struct('length', x.length, 'key', x.key, 'b', s.b))))),
        s -> s.out)"""
    out = listed.select(*groups, F.posexplode(F.expr(fold)).alias("place", "x"))
    return out.select(*groups, F.col("x.key").alias(key), F.col("x.length").alias(length), F.col("x.b").alias("batch_id"), "place")


def top_per_bin(rows: DataFrame, bin_: str, key: str, k: int) -> DataFrame:
    """The k rows of smallest key in each bin."""
    order = Window.partitionBy(bin_).orderBy(key)
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def stratified_sample(rows: DataFrame, length: str, key: str, bins: list[tuple[int, int]], count: int) -> DataFrame:
    """count rows: as many of each bin as an even share gives, filled up in key order with others."""
    number = F.coalesce(*[F.when(F.col(length).between(low, high), F.lit(i)) for i, (low, high) in enumerate(bins)])
    picked = top_per_bin(rows.withColumn("_bin", number).filter(F.col("_bin").isNotNull()), "_bin", key, max(1, count // len(bins)))
    picked = picked.drop("_bin", "place").dropDuplicates([key])
    rest = rows.join(picked.select(key), key, "left_anti").select(*picked.columns)
    return picked.withColumn("_o", F.lit(0)).unionByName(rest.withColumn("_o", F.lit(1))).orderBy("_o", key).limit(count).drop("_o")
