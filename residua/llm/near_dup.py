"""Near-duplicate documents by MinHash.

1. A pass over the texts gives each document the hash of its shingle set, many universal hash minima, and
   from these the band keys. Documents with equal sets are one class from then on, so exact copies cost
   a row of an aggregation each, however many there are.
2. Classes that share a band are candidates. A band bucket of a few classes gives its pairs, of which
   those stay whose sizes and signatures allow the similarity; a larger bucket only ties its classes
   to its smallest one.
3. Components of candidates are cells. Each class sends its full set to its cell. A cell of one block is
   compared whole and exactly. A larger one is cut into blocks, and a few of its classes, the pivots, go
   to every block: within a block all sets are compared exactly, so nearly all that belongs together
   is tied together over the pivots, and each set is sent about once.
4. What is left in such a cell are pairs in different components. These are found by their prefixes: of
   shingles ordered from rare to common, two similar sets must share one among the first few, at places
   that leave room for the rest. Those pairs are compared on full sets too. So no cell is compared pair
   by pair, however large, and no link is lost.
5. Components of the confirmed links are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.components import connected_components
from residua.session import bound_arrow_batches, staged, unstage

#: Shingles and similarity unless a caller says otherwise.
WORDS, PERCENT = 5, 80
#: Leading bits of a set's size that tell its class in the join on shingles.
SIZE_BITS = 5
#: Hash minima of a document.
MINIMA = 125
#: Classes of a band bucket that are paired directly; larger buckets become one cell.
PAIRED = 16
#: Documents and shingles of a block, about; cells of more are compared block by block.
BLOCK_DOCS, BLOCK_SHINGLES = 128, 400_000
#: One class of so many blocks' worth is a pivot: about an eighth of a block's classes.
PIVOT_SHARE = 8
#: Shingles are ordered by the counts of so many buckets.
RARITY_BUCKETS = 1 << 16

_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20


@lru_cache(maxsize=4)
def _constants(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    letters = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    upper = np.arange(65, 91)
    letters[upper] = letters[upper + 32]  # A-Z count as a-z
    return np.multiply.accumulate(up), np.multiply.accumulate(down), letters


@lru_cache(maxsize=1)
def _universal() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1)
    return a[:, None], rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)[:, None]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, A-Z lower-cased, in order."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out, at = [], 0
    while at < len(raw):  # in slices that end between words, so memory doesn't follow the text's length
        stop = min(len(raw), at + _SLICE)
        part = raw[at:stop]
        blank = (part == 32) | ((part >= 9) & (part <= 13))
        if stop < len(raw):
            last = np.flatnonzero(blank)
            if len(last):
                stop = at + int(last[-1]) + 1
            else:  # a word longer than a slice
                more = np.flatnonzero((raw[stop:] == 32) | ((raw[stop:] >= 9) & (raw[stop:] <= 13)))
                stop = stop + int(more[0]) + 1 if len(more) else len(raw)
            part = raw[at:stop]
            blank = (part == 32) | ((part >= 9) & (part <= 13))
        up, down, letters = _constants(max(1 << 17, 1 << int(len(part) - 1).bit_length()))
        edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        begin, end = edge[::2], edge[1::2]
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[part] * up[: len(part)], dtype=np.uint64)])
            out.append(_mixed((sums[end] - sums[begin]) * down[begin]))
        at = stop
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes, sorted. Fewer words than a shingle has make one; none make none."""
    h = word_hashes(text or "")
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    width = min(words, len(h))
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(width))
        for k in range(width):
            total = _mixed(total * _MIX + h[k : k + n])
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every universal hash function over the set."""
    a, b = _universal()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(x), 2048):
            np.minimum(low, (a * x[None, k : k + 2048] + b).min(axis=1), out=low)
    return low


def set_hash(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def band_rows(percent: int) -> int:
    """Minima of a band: a pair at the threshold is missed by all bands less than once in a million."""
    return 5 if percent >= 85 else 4 if percent >= 78 else 3 if percent >= 65 else 2


def _fingerprints(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n (size of the set), code (hash of the set; null if empty), bands, sketch (a byte a minimum)."""
    rows = band_rows(percent)
    bands = MINIMA // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, code, keys, sketch = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, words)
                size.append(len(found))
                if not len(found):
                    code.append(None), keys.append(None), sketch.append(None)
                    continue
                low = signature(found)
                code.append(set_hash(found))
                with np.errstate(over="ignore"):
                    key = np.arange(bands, dtype=np.uint64)
                    for k in range(rows):
                        key = _mixed(key * _MIX + low[k : bands * rows : rows])
                keys.append(key.view(np.int64))
                sketch.append((low & np.uint32(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(code, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sketch, pa.binary()),
                ],
                names=["doc_id", "n", "code", "bands", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, code binary, bands array<long>, sketch binary")


def _plausible(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, sketch_a, sketch_b), those whose signatures allow the similarity, as (a, b)."""
    t = percent / 100
    least = MINIMA * (t - 5 * (t * (1 - t) / MINIMA) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(-1, MINIMA) for k in (2, 3)
            )
            yield batch.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= least))

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that tie together all classes (node, n, bands, sketch) that may be similar."""
    laid = classes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    buckets = laid.groupBy("band", "key").agg(F.min("node").alias("hub"), F.max("node").alias("top"), F.count(F.lit(1)).alias("size"))
    shared = staged(laid.join(buckets.filter("hub < top").select("band", "key", "hub", "size").hint("merge"), ["band", "key"]), "shared")
    stars = shared.filter((F.col("size") > PAIRED) & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    few = shared.filter(F.col("size") <= PAIRED)
    left = few.select("band", "key", F.col("node").alias("a"), F.col("n").alias("n_a"))
    right = few.select("band", "key", F.col("node").alias("b"), F.col("n").alias("n_b"))
    met = left.join(right.hint("merge"), ["band", "key"]).filter(F.col("a") < F.col("b"))
    met = met.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b").distinct()
    sketches = classes.select("node", "sketch")
    met = met.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")).hint("merge"), "a")
    met = met.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")).hint("merge"), "b")
    edges = staged(_plausible(met, percent).unionByName(stars.distinct()), "candidates")
    unstage(shared)
    return edges


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For every set the smallest number of a set that a chain of similar pairs leads to. Exact."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    count = np.diff(np.append(start, len(value)))
    both = np.zeros(n * n, dtype=np.int64)
    for c in np.unique(count[(count > 1) & (count <= 32)]):  # shingles of a few sets: pair by pair
        rows = owner[start[count == c][:, None] + np.arange(c)]
        i, j = np.triu_indices(int(c), 1)
        for k in range(0, len(rows), 1 << 14):
            x, y = rows[k : k + (1 << 14), i].ravel(), rows[k : k + (1 << 14), j].ravel()
            both += np.bincount(np.minimum(x, y) * n + np.maximum(x, y), minlength=n * n)
    both = both.reshape(n, n)
    wide = np.flatnonzero(count > 32)
    for k in range(0, len(wide), 2048):  # shingles of many sets: a matrix product
        part = wide[k : k + 2048]
        held = np.zeros((n, len(part)), dtype=np.float32)
        for column, (s, c) in enumerate(zip(start[part].tolist(), count[part].tolist(), strict=True)):
            held[owner[s : s + c], column] = 1
        both += np.triu(np.rint(held @ held.T).astype(np.int64), 1)
    linked = np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1)
    linked |= linked.T
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            root[i], rest = i, [i]
            while rest:
                new = np.flatnonzero(linked[rest.pop()] & (root < 0))
                root[new] = i
                rest.extend(new.tolist())
    return root


def _placed(docs: DataFrame, members: DataFrame, *more: str) -> DataFrame:
    """The texts of members (node, code, and more), as (node, code, more, text)."""
    keyed = members.select(F.col("node").alias("doc_id"), "code", *more)
    # Never a broadcast: members grow with the table, and small tables should run like large ones.
    texts = docs.select("doc_id", "text").join(keyed.hint("merge"), "doc_id")
    return texts.select(F.col("doc_id").alias("node"), "code", *more, "text")


def _by_cell(rows: DataFrame, cells: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with cells, an aggregate a cell; on a second column too, so that the rows of one large cell can be split among tasks."""
    again = -F.col("cell")
    return rows.withColumn("again", again).join(cells.withColumn("again", again).hint("merge"), ["cell", "again"], how).drop("again")


def _places(members: DataFrame) -> DataFrame:
    """members (node, cell, blocks, and more) with `places`, the blocks of the cell that each goes to."""
    blocks = F.col("blocks").cast("long")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pivot = (F.col("node") == F.col("cell")) | (F.pmod(F.xxhash64("node", F.lit(7)), PIVOT_SHARE * blocks) == 0)
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    return members.withColumn("places", F.when(pivot & (blocks > 1), everywhere).otherwise(F.array(own)))


def _block_links(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of the similar classes within each block of each cell.

    members: node, code, n, cell, docs, blocks. The code tells the class's text from another under the same id.
    """
    sets = _placed(docs, _places(members), "cell", "places")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, code in zip(batch.column(4).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingle_set(text, words)
                out.append(found.tobytes() if set_hash(found) == code else None)
            columns = [batch.column(k) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=["node", "code", "cell", "places", "set"])

    sets = sets.mapInArrow(shingled, "node long, code binary, cell long, places array<int>, set binary")
    dealt = sets.filter(F.col("set").isNotNull()).select("cell", F.explode("places").alias("block"), "node", "code", "set")
    dealt = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "node", "code")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, held, last = None, [], [], None

        def links() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                root = similar(held, percent)
                all_ = np.array(nodes, dtype=np.int64)
                a, b = all_[root], all_
                away = np.flatnonzero(a != b)
                if len(away):
                    yield pa.RecordBatch.from_arrays([pa.array(a[away]), pa.array(b[away])], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for cell, block, node, code, raw in zip(*columns, strict=True):
                if (cell, block) != key:
                    yield from links()
                    key, nodes, held, last = (cell, block), [], [], None
                if last != (node, code):  # a repeated row is the same document
                    last = (node, code)
                    nodes.append(node)
                    held.append(np.frombuffer(raw, dtype=np.uint64))
        yield from links()

    return dealt.mapInArrow(compare, "a long, b long")


def prefix_lengths(n: int, percent: int) -> tuple[int, int]:
    """Of a set of n shingles, how many must be looked up, and how many must be found by larger sets.

    A pair at the threshold shares a shingle among the first so many of the larger and of the smaller set.
    """
    looked = n - -(-percent * n // 100) + 1
    found = n - -(-2 * percent * n // (100 + percent)) + 1
    return looked, found


def _sized(met: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The two sides of the join on shared shingles: met (cell, x, node, comp, n, place, found) as smaller and larger set.

    How early a shingle must stand depends on both sets' sizes. So sizes are cut into classes by their leading
    bits, and a row goes to each class of partners that its place leaves room with. Rows that share a common
    shingle where it is too late to be similar then never meet, however many they are.
    """

    def size(n: str) -> str:
        shift = f"greatest(length(bin({n})) - {SIZE_BITS}, 0)"
        return f"shiftleft(shiftright({n}, {shift}), {shift})"

    def classes(low: str, high: str) -> str:
        step = f"shiftleft(1L, greatest(length(bin({low})) - {SIZE_BITS}, 0))"
        return f"array_distinct(transform(sequence({size(low)}, {size(high)}, {step}), y -> {size('y')}))"

    def need(a: str, b: str) -> str:
        return f"({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent}"

    least, most = f"((n * {percent} + 99) div 100)", f"((n * 100) div {percent})"
    room_b = f"n - place >= {need(f'greatest(y, {least})', 'n')}"
    room_a = f"n - place >= {need('n', 'greatest(y, n)')}"
    larger = met.select("*", F.explode(F.expr(f"filter({classes(least, 'n')}, y -> {room_b})")).alias("size_a")).withColumn("size_b", F.expr(size("n")))
    smaller = met.filter("found").select("*", F.explode(F.expr(f"filter({classes('n', most)}, y -> {room_a})")).alias("size_b")).withColumn("size_a", F.expr(size("n")))

    def side(df: DataFrame, end: str) -> DataFrame:
        return df.select("cell", "x", "size_a", "size_b", *[F.col(c).alias(f"{c}_{end}") for c in ("node", "comp", "n", "place")])

    return side(smaller, "a"), side(larger, "b")


def _prefix_links(docs: DataFrame, rest: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) of all similar pairs of rest (node, code, n, cell, comp) in one cell but different components."""
    placed = _placed(docs, rest, "cell", "comp").dropDuplicates(["node", "code", "text"])  # as they are dealt for the join

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, code in zip(batch.column(4).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingle_set(text, words)
                out.append(found.tobytes() if set_hash(found) == code else None)
            columns = [batch.column(k) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=["node", "code", "cell", "comp", "set"])

    sets = placed.mapInArrow(shingled, "node long, code binary, cell long, comp long, set binary")
    sets = staged(sets.filter(F.col("set").isNotNull()), "sets")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY_BUCKETS, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                np.add.at(total, (np.frombuffer(raw, dtype=np.uint64) % np.uint64(RARITY_BUCKETS)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    sums = sets.select("set").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    count = np.zeros(RARITY_BUCKETS, dtype=np.int64)
    for r in sums.collect():  # a row a bucket at most
        count[r.bucket] = r.n

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, cell, comp, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                own = np.frombuffer(raw, dtype=np.uint64)
                n = len(own)
                looked, found = prefix_lengths(n, percent)
                first = own[np.lexsort((own, count[(own % np.uint64(RARITY_BUCKETS)).astype(np.int64)]))[:looked]]
                k = len(first)
                place = np.arange(k, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, cell, dtype=np.int64)),
                        pa.array(first.view(np.int64)),
                        pa.array(np.full(k, node, dtype=np.int64)),
                        pa.array(np.full(k, comp, dtype=np.int64)),
                        pa.array(np.full(k, n, dtype=np.int64)),
                        pa.array(place),
                        pa.array(place < found),
                    ],
                    names=["cell", "x", "node", "comp", "n", "place", "found"],
                )

    laid = sets.select("node", "cell", "comp", "set").mapInArrow(
        prefixes, "cell long, x long, node long, comp long, n long, place long, found boolean"
    )
    laid = staged(laid, "prefixes")
    # Only shingles that several components of a cell have can tie them.
    several = laid.groupBy("cell", "x").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least < most")
    met = laid.join(several.select("cell", "x").hint("merge"), ["cell", "x"], "left_semi")
    small, large = _sized(met, percent)
    need = F.expr(f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}")
    room = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    pairs = small.join(large.hint("merge"), ["cell", "x", "size_a", "size_b"]).filter(
        (F.col("comp_a") != F.col("comp_b"))
        & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b"))))
        & (100 * F.col("n_a") >= percent * F.col("n_b"))
        & (room >= need)
    )
    pairs = pairs.select("node_a", "node_b").distinct()
    one = pairs.join(sets.select(F.col("node").alias("node_a"), F.col("set").alias("set_a")).hint("merge"), "node_a")
    two = one.join(sets.select(F.col("node").alias("node_b"), F.col("set").alias("set_b")).hint("merge"), "node_b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    links = staged(two.select("node_a", "node_b", "set_a", "set_b").mapInArrow(confirm, "a long, b long"), "closing")
    unstage(sets), unstage(laid)
    return links


def _groups(docs: DataFrame, members: DataFrame, same: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (node, component) of what similar classes of a cell tie together, and of the edges same (a, b).

    members: node, code, n, cell.
    """
    cells = members.groupBy("cell").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    cells = cells.select(
        "cell",
        F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
    )
    sized = staged(_by_cell(members, cells).select("node", "code", "n", "cell", "blocks"), "sized")
    tied = connected_components(_block_links(docs, sized, words, percent).unionByName(same))
    cut = sized.filter("blocks > 1")
    if cut.isEmpty():
        unstage(sized)
        return tied
    known = cut.join(tied.withColumnRenamed("component", "comp").hint("merge"), "node", "left")
    known = known.select("node", "code", "n", "cell", F.coalesce("comp", "node").alias("comp"))
    several = known.groupBy("cell").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).filter("least < most")
    rest = staged(_by_cell(known, several.select("cell"), "left_semi"), "rest")
    unstage(sized)
    if rest.isEmpty():  # every large cell is one component
        unstage(rest)
        return tied
    closing = _prefix_links(docs, rest, words, percent)
    unstage(rest)
    if closing.isEmpty():
        unstage(closing)
        return tied
    groups = connected_components(closing.unionByName(tied.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    unstage(closing), unstage(tied)
    return groups


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Groups of near-duplicate rows of docs (doc_id, text), written to the shared folder.

    A document's set holds its distinct shingles of `words` words, A-Z lower-cased; two documents are
    linked if 100 * shared >= percent * union. Returns per row: doc_id, n_shingles, component_id (the
    smallest doc_id of the group), kept (doc_id = component_id). The caller may unstage() the result.

    Null and empty texts have empty sets and are linked with nothing. A row with a null doc_id belongs to
    the group of its equals, if any has an id, and is never kept; it links nothing. Repeated rows come
    out alike. Rows that share an id but not a text are one document with several texts, which is linked
    with what any of them is linked with; n_shingles is each row's own. Ties have no say: groups depend on
    links alone, and within one on the smallest id. Texts of any length are read whole, in slices. An
    empty table gives no rows; other columns are ignored.
    """
    bound_arrow_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = staged(_fingerprints(docs, words, percent), "fingerprints")
    classes = prints.filter(F.col("code").isNotNull()).groupBy("code")
    same = [F.first(c).alias(c) for c in ("n", "bands", "sketch")]  # equal sets have equal ones
    classes = staged(classes.agg(F.min("doc_id").alias("node"), *same).filter(F.col("node").isNotNull()), "classes")
    edges = _candidates(classes.select("node", "n", "bands", "sketch"), percent)
    cells = connected_components(edges)
    unstage(edges)
    members = staged(classes.select("node", "code", "n").join(cells.hint("merge"), "node").select("node", "code", "n", F.col("component").alias("cell")), "members")
    unstage(cells)
    groups = _groups(docs, members, _same_id(prints, classes), words, percent)
    named = staged(classes.select("code", "node").join(groups.hint("merge"), "node", "left").select("code", F.coalesce("component", "node").alias("group")), "groups")
    rows = prints.select("doc_id", "n", "code").join(named.hint("merge"), "code", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("group"))
    rows = rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )
    out = staged(rows, "near_duplicates")
    for table in (prints, classes, members, groups, named):
        unstage(table)
    return out


def _same_id(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes that rows of one id fall into."""
    ids = prints.filter(F.col("doc_id").isNotNull() & F.col("code").isNotNull()).select("doc_id", F.xxhash64("code").alias("h"))
    ids = ids.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).filter("low < high")
    if ids.isEmpty():
        return prints.sparkSession.createDataFrame([], "a long, b long")
    rows = prints.select("doc_id", "code").join(ids.select("doc_id").hint("merge"), "doc_id", "left_semi").distinct()
    rows = rows.join(classes.select("code", "node").hint("merge"), "code").select("doc_id", "node")
    # A class's node is the smallest id in it, so the id itself stands for the others.
    return rows.filter(F.col("doc_id") != F.col("node")).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))


def oracle_sql(words: int, percent: int) -> str:
    """near_duplicates(documents) in DuckDB, comparing all pairs that share a shingle."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, {shingle} AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - {words - 2})) AS i FROM d WHERE len(w) >= {words})
  UNION ALL SELECT DISTINCT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND {words - 1}
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), link AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS k FROM s JOIN s t USING (x) WHERE s.doc_id < t.doc_id GROUP BY ALL) p
  JOIN n u ON u.doc_id = p.a JOIN n v ON v.doc_id = p.b WHERE 100 * p.k >= {percent} * (u.n + v.n - p.k)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) l ON l.a = r.b
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""
