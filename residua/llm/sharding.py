"""Sharding by longest-processing-time scheduling: equal texts stay together, and shards are near equal in bytes.

Groups of equal keys, longest first, go to the shard with the least bytes so far, through a heap. Groups of
nearly equal size are one class: a size is known by its first PRECISION bits, so there are at most some
300,000 classes up to a petabyte, and the driver schedules their counts and sums, not their groups. A run
of groups of a class takes turns among the shards, so it is a few stretches of a cycle; each group finds
its shard by its rank in the class. Within a class a group counts with the mean, which is exact for
classes of one size; along the ranks the sizes fall, so what the mean leaves out adds up to a few sizes
of the largest group at most.

Ranks, places within groups and slots are all counted in parts first, so neither a group that holds a third
of all rows nor a class nor a shard passes through one task.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.session import shuffle_partitions, staged, unstage

SHARDS = 8
#: Leading bits of a group's bytes that tell its class; hexadecimal digits that parts are cut by.
PRECISION, DIGITS = 14, 3
#: Shards at most; with the classes this bounds the plan.
MOST_SHARDS = 4096
#: Rows of a file that write_shards() writes, at most.
FILE_ROWS = 100_000

Stretch = tuple[int, int, list[int]]


def schedule(classes: list[tuple[int, int, int]], shards: int) -> dict[int, list[Stretch]]:
    """For each class (class, groups, bytes), larger ones first, which ranks go to which shards.

    A stretch (from, to, order) deals the ranks from `from` up to `to` in turns to the shards of order. The
    outcome is that of a heap that takes one group at a time, each of the class's mean size, rounded down;
    of equal loads the smaller shard is first.
    """
    heap = [(0, k) for k in range(shards)]
    heapify(heap)
    plan: dict[int, list[Stretch]] = {}
    for name, groups, total in sorted(classes, reverse=True):
        size, at, stretches = max(total // groups, 1), 0, []
        while at < groups:
            # Those that get a group each before the first of them gets its second.
            turn = [heappop(heap)]
            while heap and len(turn) < groups - at and heap[0][0] < turn[0][0] + size:
                turn.append(heappop(heap))
            whole = len(turn) if not heap or heap[0][0] >= turn[0][0] + size else 0
            rounds = (groups - at) // len(turn)
            if heap:  # until one of the others has its turn too
                rounds = min(rounds, (heap[0][0] - turn[0][0]) // size)
            dealt = len(turn) * max(rounds, 1) if whole else len(turn)
            stretches.append((at, at + dealt, [k for _, k in turn]))
            for load, k in turn:
                heappush(heap, (load + size * (dealt // len(turn)), k))
            at += dealt
        plan[name] = stretches
    return plan


def _class(size: str) -> str:
    shift = f"greatest(length(bin({size})) - {PRECISION}, 0)"
    return f"shiftleft(shiftright({size}, {shift}), {shift})"


def _part(column: str):
    return F.substring(column, 1, DIGITS)


def assign(docs: DataFrame, shards: int = SHARDS, group: str = "text", carry: bool = False) -> DataFrame:
    """Where each row of docs (doc_id, text) goes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Rows of the same `group` (a column, compared as a string; null is the empty one) share a shard and stand
    together in it. size is the text's UTF-8 bytes plus one. Slots number a shard's rows from 0 without a gap.
    With carry, `row` holds the whole row too. The table is staged; the caller may unstage() it.

    A null text is empty and has size 1. Long texts count whole; only their hash goes through shuffles. Equal
    sizes go by the hash of the group, rows of a group by their id. Null and repeated doc_ids are rows like
    others. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"shards must be from 1 to {MOST_SHARDS}")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("")), 256).alias("digest"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    # Groups are counted in salted parts.
    salt = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, DIGITS)
    part = Window.partitionBy("digest", "salt")
    order = part.orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    placed = rows.withColumn("salt", salt).withColumn("place", F.row_number().over(order) - 1)
    placed = staged(placed, "sharding-rows")
    parts = placed.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))
    before = Window.partitionBy("digest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(parts.withColumn("ahead", F.coalesce(F.sum("rows").over(before), F.lit(0))), "sharding-parts")
    groups = parts.groupBy("digest").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).withColumn("class", F.expr(_class("bytes")))
    groups = staged(groups, "sharding-groups")

    found = groups.groupBy("class").agg(F.count(F.lit(1)).alias("groups"), F.sum("bytes").alias("bytes")).collect()
    plan = schedule([(r["class"], r["groups"], r["bytes"]) for r in found], shards)
    kind = "class long, stretches array<struct<at: long, to: long, turn: array<int>>>"
    table = F.broadcast(spark.createDataFrame(list(plan.items()), kind))  # a row a class

    # Rank in the class, by falling size: counts by size and part of the hash go first.
    keys = ["class", "bytes", "part"]
    ranked = groups.withColumn("part", _part("digest"))
    ahead = Window.partitionBy("class").orderBy(F.col("bytes").desc(), "part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("digest")) - 1)
    ranked = ranked.join(counts.hint("merge"), keys).withColumn("rank", F.col("offset") + F.col("place"))
    mine = F.expr("filter(stretches, x -> rank >= x.at and rank < x.to)[0]")
    dealt = ranked.join(table, "class").withColumn("x", mine)
    dealt = dealt.select("digest", "rows", "part", F.expr("get(x.turn, int((rank - x.at) % size(x.turn)))").alias("shard"))
    dealt = staged(dealt, "sharding-dealt")

    # First slot of a group, in the order of its hash.
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("shard", "part").agg(F.sum("rows").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.withColumn("within", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    first = first.join(sums.hint("merge"), ["shard", "part"]).select("digest", "shard", (F.col("offset") + F.col("within")).alias("first"))

    starts = parts.join(first.hint("merge"), "digest").select("digest", "salt", "shard", (F.col("first") + F.col("ahead")).alias("start"))
    out = placed.join(starts.hint("merge"), ["digest", "salt"])
    out = out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["row"] if carry else []),
    )
    out = staged(out, "sharding")
    for step in (placed, parts, groups, dealt):
        unstage(step)
    return out


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, group: str = "text", file_rows: int = FILE_ROWS) -> None:
    """Write the rows of docs as Parquet files shard=K/..., in the order of their slots, with the column slot.

    A file holds file_rows rows in a row; a row's own shard or slot is written as `_shard` or `_slot`. Rows are
    otherwise handled as assign() says. What the path held before is overwritten.
    """
    found = assign(docs, shards, group, carry=True)
    own = [F.col(f"row.`{c}`").alias(f"_{c}" if c in ("shard", "slot") else c) for c in docs.columns]
    rows = found.select("shard", "slot", F.floor(F.col("slot") / file_rows).alias("_file"), *own)
    rows = rows.repartition(shuffle_partitions(docs.sparkSession), "shard", "_file").sortWithinPartitions("shard", "_file", "slot").drop("_file")
    rows.write.mode("overwrite").partitionBy("shard").option("maxRecordsPerFile", file_rows).parquet(path)
    unstage(found)


def oracle_sql(shards: int = SHARDS) -> str:
    """DuckDB SQL for assign() over documents: the heap as a recursion, one group after another."""
    shift = f"greatest(length(bin(bytes)) - {PRECISION}, 0)"
    digits = "0123456789ABCDEF"
    return f"""
WITH RECURSIVE polynomial AS (
    SELECT list(c ORDER BY n) AS crcs FROM (
        SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS n))
), texts AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), digits AS (
    SELECT doc_id, t, string_split(hex(t), '') AS h FROM texts
), bytes_of AS (
    SELECT doc_id, sha256(t) AS digest, strlen(t) + 1 AS size, CASE WHEN t = '' THEN []::BIGINT[] ELSE
        list_transform(range(1, len(h), 2), lambda i: (strpos('{digits}', h[i]) - 1) * 16 + strpos('{digits}', h[i + 1]) - 1) END AS b FROM digits
), docs AS MATERIALIZED (
    SELECT doc_id, digest, size,
        xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
    FROM bytes_of, polynomial
), groups AS (
    SELECT digest, sum(size)::BIGINT AS bytes FROM docs GROUP BY digest
), classes AS (
    SELECT digest, bytes, (bytes >> {shift}) << {shift} AS class FROM groups
), queue AS MATERIALIZED (
    SELECT digest, greatest((sum(bytes) OVER (PARTITION BY class))::BIGINT // count(*) OVER (PARTITION BY class), 1) AS size,
        row_number() OVER (ORDER BY bytes DESC, digest) AS i FROM classes
), heap AS (
    SELECT 0::BIGINT AS i, list_transform(range({shards}), lambda k: 0::BIGINT) AS loads, NULL::BIGINT AS shard
    UNION ALL
    SELECT q.i, list_transform(h.loads, lambda x, k: x + CASE WHEN k = h.best THEN q.size ELSE 0 END), h.best - 1
    FROM (SELECT *, list_position(loads, list_min(loads)) AS best FROM heap) h JOIN queue q ON q.i = h.i + 1
)
SELECT d.doc_id, d.size, d.text_crc32, 'bytes' AS law, h.shard::INTEGER AS shard,
    row_number() OVER (PARTITION BY h.shard ORDER BY d.digest, md5(coalesce(d.doc_id::VARCHAR, ''))[1:{DIGITS}], d.doc_id NULLS FIRST) - 1 AS slot,
    NULL::INTEGER AS grown_shard
FROM docs d JOIN queue q ON q.digest = d.digest JOIN heap h ON h.i = q.i
"""
