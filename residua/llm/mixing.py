"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Each source's documents, in a fixed random order, are cut into blocks of equal length. Time is a sequence
of slots of one block. In a period of D slots a source with g shares of D gets g blocks; its k-th block is
released at floor(k D / g) and due at ceil((k + 1) D / g). Of the released blocks the one due first gets
the slot, so at any time a source has less than one block more or less than its weight says. When a
source has no blocks left, the others share its slots in proportion and a new phase begins, so every
document gets a place.

Weights that a caller gives are taken as they are written, as whole shares of a common denominator; that
is the period, so the bound holds for them exactly, however long the mixture. Without weights a source
has a thousandth of a period for every thousandth of the square roots of the sources' lengths, rounded,
and one at least.

A period is scheduled once for each phase, on a row with one element a source; periods repeat, so a
document's slot follows from its block number. Of more than MAX_SOURCES sources, or with periods longer
than LONG_PERIOD, the same phases are computed on the driver, where no more slots are gone through than
there are blocks. Where both a period and the blocks are more than MAX_SLOTS, blocks are made longer. The
running length of a source is summed in chunks and then within them, so no source has to pass through one
task.
"""

from __future__ import annotations

import math
from fractions import Fraction
from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residua.session import shuffle_partitions

#: Characters of a block.
BLOCK_CHARS = 1 << 16
#: Slots of a period, about, where sources have no weights; and a source without a weight has this part of those given.
PERIOD = 1000
#: Slots of a period that one row of the plan is scheduled for, and slots that the driver goes through, at most.
LONG_PERIOD, MAX_SLOTS = 2048, 1 << 20
#: Characters of a file that in_order writes, at most, on average.
FILE_CHARS = 1 << 27
#: Sources at most, unless the caller allows more; and sources that one row of the plan is scheduled for.
MAX_SOURCES = 256
#: Documents of a chunk, about.
CHUNK_DOCS = 512


def _digest(doc_id: Column, text: Column) -> Column:
    """What the documents of a source are ordered by."""
    return F.md5(F.concat_ws("/", doc_id.cast("string"), text.cast("string")).cast("binary"))


def _plan(sources: DataFrame) -> DataFrame:
    """The phases of each source: source, first and last (blocks), at (slot), shares, period, places.

    sources: source, blocks, share; one row each, at most MAX_SOURCES.
    """
    listed = F.array_sort(F.collect_list(F.struct("source", "blocks", "share")))
    row = sources.agg(listed.alias("s"))
    # One period of shares g: each slot goes to the released block that is due first.
    period = """aggregate(sequence(0, d - 1),
        named_struct('n', transform(g, x -> 0), 'order', cast(array() as array<int>)),
        (a, t) -> element_at(transform(array(array_min(transform(
                filter(transform(a.n, (n, i) -> named_struct('n', n, 'i', i)),
                    x -> x.n < get(g, x.i) and (x.n * d) div get(g, x.i) <= t),
                x -> named_struct('due', ((x.n + 1) * d + get(g, x.i) - 1) div get(g, x.i), 'i', x.i))).i),
            best -> named_struct('n', transform(a.n, (n, i) -> if(i = best, n + 1, n)), 'order', concat(a.order, array(best)))), 1),
        a -> a.order)"""
    places = "transform(g, (x, i) -> filter(transform(o, (y, k) -> if(y = i, k, -1)), k -> k >= 0))"
    # The phase ends with the last block of the first source that runs out.
    until = """array_min(transform(filter(transform(g, (x, i) -> named_struct('g', x, 'left', get(s, i).blocks - get(acc.done, i), 'p', get(p, i))), x -> x.g > 0),
        x -> ((x.left - 1) div x.g) * d + get(x.p, int((x.left - 1) % x.g)))) + 1"""
    given = "transform(g, (x, i) -> get(acc.done, i) + (e div d) * x + size(filter(get(p, i), k -> k < e % d)))"
    phase = """named_struct('at', acc.at, 'd', d, 'g', g, 'p', p, 'first', acc.done, 'last', done)"""

    def let(name: str, value: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    shares = "transform(s, (x, i) -> if(get(acc.done, i) < x.blocks, int(x.share), 0))"
    total = "aggregate(g, 0, (a, x) -> a + x)"
    after = f"named_struct('at', acc.at + e, 'done', done, 'phases', concat(acc.phases, array({phase})))"
    step = let("g", shares, let("d", total, f"if(d = 0, acc, {let('o', period, let('p', places, let('e', until, let('done', given, after))))})"))
    kind = "array<struct<at:bigint,d:int,g:array<int>,p:array<array<int>>,first:array<bigint>,last:array<bigint>>>"
    phases = f"""aggregate(s, named_struct('at', 0L, 'done', transform(s, x -> 0L), 'phases', cast(array() as {kind})),
        (acc, unused) -> {step}, acc -> acc.phases)"""
    rows = row.select("s", F.explode(F.expr(phases)).alias("f")).select("f", F.posexplode("s").alias("i", "x"))
    rows = rows.select(
        F.col("x.source").alias("source"),
        F.expr("get(f.first, i)").alias("first"),
        F.expr("get(f.last, i)").alias("last"),
        F.col("f.at").alias("at"),
        F.expr("get(f.g, i)").alias("share"),
        F.col("f.d").alias("period"),
        F.expr("get(f.p, i)").alias("places"),
    )
    return rows.filter(F.col("first") < F.col("last"))


_PHASES = "source string, first long, last long, at long, share long, period long, places array<int>"
_LONGEST = 1 << 62


def _phases(sources: list[tuple[str | None, int, int]]) -> list[tuple]:
    """What _plan gives, for (source, blocks, share) of any number of sources: rows of _PHASES.

    A phase that ends within its period is gone through up to its end only.
    """
    sources = sorted(sources, key=lambda x: (x[0] is not None, (x[0] or "").encode("utf-8", "surrogatepass")))
    live, done, at, out = list(range(len(sources))), [0] * len(sources), 0, []
    while live:
        period = sum(sources[i][2] for i in live)
        ready = [(-(-period // sources[i][2]), i) for i in live]  # due, source
        heapify(ready)
        later: list[tuple[int, int]] = []  # release, source
        places: dict[int, list[int]] = {}
        end = 0
        for t in range(period):
            while later and later[0][0] <= t:
                i = heappop(later)[1]
                heappush(ready, (-(-(len(places[i]) + 1) * period // sources[i][2]), i))
            i = heappop(ready)[1]
            found = places.setdefault(i, [])
            found.append(t)
            if done[i] + len(found) == sources[i][1]:
                end = t + 1
                break
            if len(found) < sources[i][2]:
                heappush(later, (len(found) * period // sources[i][2], i))
        if not end:  # all have had their share of the period, which repeats
            left = {i: sources[i][1] - done[i] - 1 for i in live}
            end = min(left[i] // sources[i][2] * period + places[i][left[i] % sources[i][2]] for i in live) + 1
        for i, found in places.items():
            given = end // period * sources[i][2] + sum(k < end % period for k in found)
            if given:
                # Numbers beyond a long belong to a period that isn't gone through to its end.
                out.append((sources[i][0], done[i], done[i] + given, at, min(sources[i][2], _LONGEST), min(period, _LONGEST), found))
                done[i] += given
        at += end
        live = [i for i in live if done[i] < sources[i][1]]
    return out


def whole_shares(weights: dict[str | None, float], sources: list[str | None]) -> dict[str | None, int]:
    """The share of each source, in the smallest whole numbers that are to each other as the weights are.

    A float is the decimal number that it is written as. A source without a weight has 1/PERIOD of all those given.
    """
    given = {k: Fraction(repr(w)) if isinstance(w, float) and math.isfinite(w) else Fraction(w) for k, w in weights.items()}
    if not given or min(given.values()) <= 0:
        raise ValueError("weights must be positive")
    rest = sum(given.values()) / PERIOD
    exact = {s: given.get(s, rest) for s in sources}
    unit = math.lcm(*(x.denominator for x in exact.values())) if exact else 1
    shares = {s: int(x * unit) for s, x in exact.items()}
    common = math.gcd(*shares.values()) or 1
    return {s: x // common for s, x in shares.items()}


def _root_shares(sizes: DataFrame) -> DataFrame:
    """sizes with `share`, a source's slots in a period, by the square root of its length."""
    root = F.floor(F.sqrt(F.col("mass").cast("double"))).cast("long")
    total = F.sum("root").over(Window.partitionBy(F.lit(1)))
    rounded = F.expr(f"(2 * {PERIOD} * root + total) div (2 * total)")
    return sizes.withColumn("root", root).withColumn("total", total).withColumn("share", F.greatest(F.lit(1), rounded).cast("int")).drop("root", "total")


def schedule(
    rows: DataFrame, weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS, max_sources: int | None = MAX_SOURCES
) -> tuple[DataFrame, int]:
    """Give each of rows (source, mass, digest, and whatever else) its block, start and slot; also their mass.

    Raises for more than max_sources sources; None allows any number, of which the driver then holds the
    sizes and the plan.
    """
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("mass").alias("mass"))
    known = (sizes if max_sources is None else sizes.limit(max_sources + 1)).collect()
    if max_sources is not None and len(known) > max_sources:
        raise ValueError(f"more than {max_sources} sources; group them first")
    mass = sum(r.mass for r in known)
    given = None if weights is None else whole_shares(weights, [r.source for r in known])
    if given and sum(given.values()) > MAX_SLOTS:
        block_chars = max(block_chars, -(-mass // MAX_SLOTS))
    blocks = F.expr(f"(mass + {block_chars - 1}) div {block_chars}")
    if given is None and len(known) <= MAX_SOURCES:
        plan = _plan(_root_shares(sizes.withColumn("blocks", blocks)))
    elif given is not None and len(known) <= MAX_SOURCES and sum(given.values()) <= LONG_PERIOD:
        share = F.lit(given.get(None, 1))
        if named := [F.lit(x) for k, n in sorted((k, n) for k, n in given.items() if k is not None) for x in (k, n)]:
            share = F.coalesce(F.try_element_at(F.create_map(*named), F.col("source")), share)
        plan = _plan(sizes.withColumn("blocks", blocks).withColumn("share", share))
    else:
        if given is None:
            given = {r.source: r.share for r in _root_shares(sizes).collect()}
        held = [(r.source, -(-r.mass // block_chars), given[r.source]) for r in known]
        plan = rows.sparkSession.createDataFrame(_phases(held), _PHASES)
    plan = F.broadcast(plan)
    # Chunks of the digest's range, as many for a source as its documents need.
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("docs") / CHUNK_DOCS))).cast("int")
    cut = F.broadcast(sizes.select(F.col("source").alias("_source"), bits.alias("bits")))
    head = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    dealt = rows.join(cut, F.col("source").eqNullSafe(F.col("_source")))
    dealt = dealt.withColumn("chunk", F.call_function("shiftright", head, 60 - F.col("bits"))).drop("_source", "bits")
    sums = dealt.groupBy("source", "chunk").agg(F.sum("mass").alias("_sum"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(
        F.col("source").alias("_source"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_begin")
    )
    dealt = dealt.join(begins, F.col("source").eqNullSafe(F.col("_source")) & (F.col("chunk") == F.col("_chunk")))
    within = Window.partitionBy("source", "chunk").orderBy("digest", "mass").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.withColumn("start", F.col("_begin") + F.sum("mass").over(within) - F.col("mass"))
    dealt = dealt.withColumn("block", F.expr(f"start div {block_chars}")).drop("_source", "_chunk", "_begin", "chunk")
    plan = plan.select(F.col("source").alias("_source"), "first", "last", "at", "share", "period", "places")
    placed = dealt.join(
        plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") >= F.col("first")) & (F.col("block") < F.col("last"))
    )
    slot = F.expr("at + ((block - first) div share) * period + get(places, int((block - first) % share))")
    placed = placed.withColumn("slot", slot).drop("_source", "first", "last", "at", "share", "period", "places")
    return placed, mass


def _measured(docs: DataFrame, *more: Column) -> DataFrame:
    mass = (F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + 1).cast("long")
    source = F.col("source").cast("string")
    return docs.select(*more, source.alias("source"), mass.alias("mass"), _digest(F.col("doc_id"), F.col("text")).alias("digest"))


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS, max_sources: int | None = MAX_SOURCES
) -> DataFrame:
    """The place of every row of docs (doc_id, text, source) in the mixture.

    doc_id, source, block (number in its source), start (characters of its source before it), slot; the
    mixture is the order by slot and start. A document counts its characters and one more. Without
    weights, sources weigh as the square root of their length; a source that weights don't name has a
    thousandth of all that they give. More than max_sources sources raise an error; None allows any number.

    Null texts are empty; a null source is a source of its own, whose weight is under None; a text longer
    than a block stands in the block that it starts in, and the next blocks of its source may be empty; null
    and repeated doc_ids are placed row by row, and rows that tie in id and text one after another; an empty
    table gives no rows; other columns are ignored.
    """
    rows, _ = schedule(_measured(docs, F.col("doc_id").cast("long").alias("doc_id")), weights, block_chars, max_sources)
    return rows.select("doc_id", "source", "block", "start", "slot")


def in_order(
    docs: DataFrame, weights: dict[str | None, float] | None = None, block_chars: int = BLOCK_CHARS, max_sources: int | None = MAX_SOURCES
) -> DataFrame:
    """All rows and columns of docs, sorted into the order of the mixture, as files keep it when written."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows, mass = schedule(_measured(docs, whole), weights, block_chars, max_sources)
    parts = max(shuffle_partitions(docs.sparkSession), -(-mass // FILE_CHARS))
    return rows.repartitionByRange(parts, "slot", "start").sortWithinPartitions("slot", "start").select("row.*")


def oracle_sql(block_chars: int = BLOCK_CHARS, weights: dict[str, float] | None = None) -> str:
    """mix(documents) in DuckDB, simulating slot after slot."""
    share = f"greatest(1, (2 * {PERIOD} * root + (SELECT CAST(sum(root) AS BIGINT) FROM size)) // (2 * (SELECT CAST(sum(root) AS BIGINT) FROM size)))"
    if weights:
        shares = whole_shares(weights, [*weights, None])
        named = " ".join(f"WHEN '{k}' THEN {n}" for k, n in shares.items() if k is not None)
        share = f"CAST(CASE source {named} ELSE {shares[None]} END AS BIGINT)"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, length(coalesce(text, '')) + 1 AS mass, md5(concat_ws('/', CAST(doc_id AS VARCHAR), text)) AS digest FROM documents
), p AS MATERIALIZED (
  SELECT doc_id, source, CAST(sum(mass) OVER (PARTITION BY source ORDER BY digest, mass ROWS UNBOUNDED PRECEDING) - mass AS BIGINT) AS start FROM d
), size AS (
  SELECT source, CAST(sum(mass) AS BIGINT) AS mass, CAST(floor(sqrt(CAST(sum(mass) AS DOUBLE))) AS BIGINT) AS root FROM d GROUP BY source
), src AS MATERIALIZED (
  SELECT list(source ORDER BY source NULLS FIRST) AS name, list((mass + {block_chars - 1}) // {block_chars} ORDER BY source NULLS FIRST) AS blocks,
         list({share} ORDER BY source NULLS FIRST) AS share
  FROM size
), run AS (
  -- slot, blocks given so far, the same at the start of the phase, its first slot, the source of the slot before and its block
  SELECT CAST(0 AS BIGINT) AS slot, list_transform(blocks, lambda x: CAST(0 AS BIGINT)) AS done, list_transform(blocks, lambda x: CAST(0 AS BIGINT)) AS base,
         CAST(0 AS BIGINT) AS since, CAST(0 AS BIGINT) AS chosen, CAST(-1 AS BIGINT) AS block
  FROM src WHERE name IS NOT NULL
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda x, i: x + CASE WHEN i = best THEN 1 ELSE 0 END),
         CASE WHEN done[best] + 1 = blocks[best] THEN list_transform(done, lambda x, i: x + CASE WHEN i = best THEN 1 ELSE 0 END) ELSE base END,
         CASE WHEN done[best] + 1 = blocks[best] THEN slot + 1 ELSE since END, best, done[best]
  FROM (
    SELECT *, list_min(list_transform(list_filter(range(1, len(done) + 1), lambda i: done[i] < blocks[i] AND ((done[i] - base[i]) * total) // share[i] <= slot - since),
                lambda i: {{'due': ((done[i] - base[i] + 1) * total + share[i] - 1) // share[i], 'i': i}})).i AS best
    FROM (SELECT run.*, src.blocks, src.share,
                 list_sum(list_transform(range(1, len(done) + 1), lambda i: CASE WHEN base[i] < src.blocks[i] THEN src.share[i] ELSE 0 END))::BIGINT AS total
          FROM run, src) WHERE total > 0
  )
)
SELECT p.doc_id, p.source, p.start // {block_chars} AS block, p.start, run.slot - 1 AS slot
FROM p, src, run
WHERE run.block = p.start // {block_chars} AND run.chosen > 0 AND src.name[run.chosen] IS NOT DISTINCT FROM p.source"""
