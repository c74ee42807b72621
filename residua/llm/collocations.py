"""Collocations of each language, by merged count-min sketches and an exact second pass.

1. Each task hashes the 1- to 4-word phrases of its texts, a chunk at a time, to cells of a sketch of
   2^bits counters. A chunk's counters are mostly nought, so it is sent as the sorted cells of each block of
   2^16, each repeated as often as it was hit. Blocks are merged where they meet in the shuffle. A counter
   is never less than any phrase in its cell, so a phrase that occurs often enough is in a cell that is full.
2. Full cells come back as one bitmap of SEGMENTS * 2^16 bits, 32 MB however large the corpus is; cells that
   share a bit only let more through. It is broadcast.
3. The second pass goes over all texts again, keeps the phrases whose bit is set, and counts these exactly,
   by their words. What the sketch let through in error falls out here.
4. Cuts are looked up among the counted phrases, as each part of a frequent phrase is frequent itself.
   Phrases within longer ones are dropped, and each language's best are ranked.

Counters need go no higher than the least count, so no phrase, however frequent, sends more than that many
cells a chunk, and no block is hot.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from residua.session import bound_arrow_batches, shuffle_partitions, staged, unstage

#: Words of a phrase, occurrences that make it a candidate, and phrases reported of each language.
MOST_WORDS, LEAST, TOP = 4, 30, 2000
#: A phrase goes if a longer one that holds it occurs at least this often, in hundredths of its own count.
SUBSUMED = 80
#: Scores are in units of this, divided by 2.
SCALE = 2_000_000
#: The sketch has 2 to this many counters. 32 suit some 10^11 occurrences of phrases; more need more.
BITS = 32
#: Bits of a counter's number within its block; blocks of the bitmap.
LOW, SEGMENTS = 16, 1 << 12
#: Bytes of text that are hashed at once; a longer text is gone through in slices.
CHUNK = 8 << 20
#: Entries of a block that are merged before they are shortened to what the least count needs.
MERGED = 1 << 21
#: Tables that a hot word's count is copied to, so that phrases with it can be spread.
SALTS = 16

# Kinds of bytes: 0 of a word, 1 between words, 2 between pieces. Fixed values.
_SPACES, _BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(_SPACES)], _KIND[list(_BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = re.compile(b"[" + re.escape(_BREAKS) + b"]")
# Random values of bytes, so that words of few kinds of letters don't collide; a space adds nothing to a hash.
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[0x20] = 0
_BASE, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _NEXT
    h = (h ^ (h >> np.uint64(32))) * _NEXT
    return h ^ (h >> np.uint64(32))


class _Words:
    """The words of a chunk of texts: their bytes, each word followed by one space, and what is known of each."""

    def __init__(self, entries: list[tuple[int, bytes, int]]):
        """entries: language, text, and how many words at the text's start were counted before."""
        raw = np.frombuffer(b"\n".join(text for _, text, _ in entries) + b"\n", dtype=np.uint8)
        kind = _KIND[raw]
        edges = np.flatnonzero(np.diff(np.concatenate([[1], (kind > 0).view(np.int8)])))
        starts, ends = edges[::2], edges[1::2]  # the last byte ends a word, if one is open
        keep = kind == 0
        keep[ends] = True
        self.bytes = _LOWER[raw]
        self.bytes[ends] = 0x20
        self.bytes = self.bytes[keep]
        self.lengths = ends - starts
        self.starts = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        sizes = np.array([len(text) + 1 for _, text, _ in entries])
        first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
        self.lang = np.repeat(np.array([lang for lang, _, _ in entries], dtype=np.int32), np.diff(first))
        self.fresh = np.ones(len(starts), dtype=bool)
        for at, (_, _, known) in zip(first.tolist(), entries, strict=False):
            self.fresh[at : at + known] = False

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        place = np.arange(len(self.bytes)) - np.repeat(self.starts, self.lengths + 1)
        powers = _powers(1 << int(self.lengths.max() + 1).bit_length())
        return _mixed(np.add.reduceat(_BYTE[self.bytes] * powers[place], self.starts))

    def phrases(self, seeds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of words, the phrases' hashes and the places of their first words."""
        words = self.hashes()
        run = _mixed(words + seeds[self.lang])
        for n in range(1, MOST_WORDS + 1):
            if n > 1:
                run = _mixed(run[:-1] * _BASE + words[n - 1 :])
            if not len(run):
                return
            whole = self.fresh[n - 1 :] & (self.piece[: len(run)] == self.piece[n - 1 :])
            at = np.flatnonzero(whole)
            yield n, run[at], at

    def texts(self, at: np.ndarray, n: int) -> pa.Array:
        """The phrases of n words that begin at the places given, joined by spaces."""
        start = self.starts[at]
        length = self.starts[at + n - 1] + self.lengths[at + n - 1] - start
        ends = np.cumsum(length)
        index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.bytes[index]))


def _slices(text: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    """A text in slices of about `most` bytes at least, each led by up to three words of the slice before that its first
    words may stand in a phrase with, and their number. A word is never cut."""
    at, lead = 0, []
    while len(text) - at > most:
        kinds = _KIND[np.frombuffer(text, np.uint8, most, at)]
        found = np.flatnonzero(kinds)
        if len(found) and found[-1]:
            cut = at + int(found[-1])
        else:  # one word longer than a slice
            after = re.compile(b"[" + re.escape(_SPACES + _BREAKS) + b"]").search(text, at + 1)
            if after is None:
                break
            cut = after.start()
        part = b" ".join([*lead, text[at:cut]])
        yield part, len(lead)
        last = max((m.end() for m in _BREAK.finditer(part)), default=0)
        lead = part[last:].replace(b"\t", b" ").split(b" ")
        lead = [w for w in lead if w][-(MOST_WORDS - 1) :]
        at = cut
    yield b" ".join([*lead, text[at:]]), len(lead)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[_Words, list[str]]]:
    """The words of batches (lang, text) in chunks of about `most` bytes, and the names of their languages."""
    entries: list[tuple[int, bytes, int]] = []
    langs: dict[str, int] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for part, known in _slices(text.as_buffer().to_pybytes(), most):
                if size and size + len(part) > most:
                    yield _Words(entries), list(langs)
                    entries, langs, size = [], {}, 0
                entries.append((langs.setdefault(lang, len(langs)), part, known))
                size += len(part) + 1
    if entries:
        yield _Words(entries), list(langs)


def _seeds(langs: list[str]) -> np.ndarray:
    parts = [np.frombuffer(x.encode() or b"\0", np.uint8) for x in langs]
    return np.array([_mixed((_BYTE[p] * _powers(1 << (len(p) + 1).bit_length())[1 : len(p) + 1]).sum(keepdims=True))[0] for p in parts])


def _full(cells: np.ndarray, least: int) -> np.ndarray:
    """Sorted cells, each at most `least` times."""
    keep = np.ones(len(cells), dtype=bool)
    keep[least:] = cells[least:] != cells[:-least]
    return cells[keep]


def _sketch(least: int, bits: int, chunk: int):
    kind, shift = (np.uint32, 64 - bits) if bits <= 32 else (np.uint64, 64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in _chunks(batches, chunk):
            found = [(h >> np.uint64(shift)).astype(kind) for _, h, _ in words.phrases(_seeds(langs))]
            cells = np.concatenate([np.zeros(0, kind), *found])
            if not len(cells):
                continue
            cells.sort()
            cells = _full(cells, least)
            block = (cells >> kind(LOW)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            offsets = (np.append(first, len(cells)) * 2).astype(np.int32)
            data = pa.py_buffer((cells & kind((1 << LOW) - 1)).astype("<u2"))
            block = block[first]
            columns = [
                pa.array((block % SEGMENTS).astype(np.int32)),
                pa.array(block),
                pa.Array.from_buffers(pa.binary(), len(block), [None, pa.py_buffer(offsets), data]),
            ]
            yield from pa.Table.from_arrays(columns, names=["segment", "block", "cells"]).to_batches(max_chunksize=8192)

    return run


def _merge(least: int):
    """Blocks in order become the segments of the bitmap: a bit for every cell with `least` hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, block, bitmap = -1, -1, np.zeros(1 << LOW, dtype=bool)
        parts: list[np.ndarray] = []
        held = 0

        def sealed() -> None:
            if held >= least:
                cells = np.sort(np.concatenate(parts))
                bitmap[cells[least - 1 :][cells[least - 1 :] == cells[: len(cells) - least + 1]]] = True

        def done() -> pa.RecordBatch:
            packed = np.packbits(bitmap, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([packed], pa.binary())], names=["segment", "bits"])

        for batch in batches:
            rows, blocks, cells = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            values = np.frombuffer(cells.buffers()[2], dtype="<u2") if cells.buffers()[2] else np.zeros(0, "<u2")
            offsets = np.frombuffer(cells.buffers()[1], dtype=np.int32)[cells.offset : cells.offset + len(cells) + 1] // 2
            first = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]]))
            for at, to in zip(first.tolist(), [*first[1:].tolist(), len(blocks)], strict=True):
                if blocks[at] != block:
                    sealed()
                    parts, held, block = [], 0, blocks[at]
                    if rows[at] != segment:
                        if segment >= 0:
                            yield done()
                        segment = int(rows[at])
                        bitmap[:] = False
                parts.append(values[offsets[at] : offsets[to]])
                held += len(parts[-1])
                if held > MERGED:
                    parts = [_full(np.sort(np.concatenate(parts)), least)]
                    held = len(parts[0])
            parts = [p.copy() for p in parts]  # they outlive the batch
        if segment >= 0:
            sealed()
            yield done()

    return run


def _count(bits: int, chunk: int, shared):
    shift = np.uint64(64 - bits)
    names = ["lang", "words", "phrase", "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, dtype=np.uint8)
        for words, langs in _chunks(batches, chunk):
            spoken = pa.array(langs)
            total = np.bincount(words.lang[words.fresh], minlength=len(langs))
            none, empty = np.zeros(len(langs), np.int32), [""] * len(langs)
            yield pa.RecordBatch.from_arrays([spoken, pa.array(none), pa.array(empty), pa.array(total.astype(np.int64))], names=names)
            for n, h, at in words.phrases(_seeds(langs)):
                bit = (h >> shift) & np.uint64((SEGMENTS << LOW) - 1)
                through = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
                h, at = h[through > 0], at[through > 0]
                _, first, times = np.unique(h, return_index=True, return_counts=True)
                at = at[first]
                for k in range(0, len(at), 100_000):
                    some = at[k : k + 100_000]
                    columns = [
                        spoken.take(pa.array(words.lang[some])),
                        pa.array(np.full(len(some), n, np.int32)),
                        words.texts(some, n),
                        pa.array(times[k : k + 100_000].astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """Phrases of 1 to MOST_WORDS words that occur `least` times or more in a language: lang, words, phrase, f.

    Rows with no words and an empty phrase give all word occurrences of a language. The table is staged; the
    caller may unstage() it. Within a chunk phrases are told apart by 64-bit hashes, beyond it by their words.
    Nulls, empty and long texts, repeats and clashing columns are handled as collocations() says.
    """
    if least < 1 or chunk < 1 or not 28 <= bits <= 48:
        raise ValueError("least and chunk must be positive, and bits between 28 and 48")
    spark = docs.sparkSession
    bound_arrow_batches(spark)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sketch = rows.mapInArrow(_sketch(least, bits, chunk), "segment int, block long, cells binary")
    blocks = sketch.repartition(shuffle_partitions(spark), "segment").sortWithinPartitions("segment", "block")
    bitmap = np.zeros((SEGMENTS, 1 << (LOW - 3)), dtype=np.uint8)
    for row in blocks.mapInArrow(_merge(least), "segment int, bits binary").collect():  # SEGMENTS rows at most
        bitmap[row.segment] = np.frombuffer(row.bits, dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.tobytes())
    counted = rows.mapInArrow(_count(bits, chunk, shared), "lang string, words int, phrase string, f long")
    counted = counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    out = staged(counted.filter((F.col("f") >= least) | (F.col("words") == 0)), "phrases")
    shared.destroy()
    return out


def _scored(frequent: DataFrame) -> DataFrame:
    """The candidates with their weakest cut: lang, words, phrase, a, l, r, score."""
    phrases = frequent.filter(F.col("words") > 0)
    candidates = phrases.filter(F.col("words") > 1)
    cuts = candidates.select(
        "lang", "words", "phrase", "f", F.split("phrase", " ").alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    sides = F.array(
        F.struct(F.lit("l").alias("side"), F.col("k").alias("n"), F.array_join(F.slice("w", 1, F.col("k")), " ").alias("part")),
        F.struct(F.lit("r").alias("side"), (F.col("words") - F.col("k")).alias("n"), F.array_join(F.slice("w", F.col("k") + 1, F.lit(MOST_WORDS)), " ").alias("part")),
    )
    parts = cuts.select("lang", "words", "phrase", "f", "k", F.explode(sides).alias("x"))
    # A common word is a part of many phrases, so its count stands under several salts.
    salt = F.when(F.col("x.n") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(0)
    parts = parts.select("lang", "words", "phrase", "f", "k", "x.side", F.col("x.part").alias("part"), salt.alias("salt"))
    salts = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("n_part"), F.explode(salts).alias("salt"))
    found = parts.join(counts.hint("merge"), ["lang", "part", "salt"])

    def of(side: str, k: int):
        return F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("n_part"))).alias(f"{side}{k}")

    wide = found.groupBy("lang", "words", "phrase", F.col("f").alias("a")).agg(*[of(s, k) for k in range(1, MOST_WORDS) for s in "lr"])
    exact = "(cast({s} as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))"
    options = ", ".join(f"named_struct('score', {exact.format(s=SCALE, k=k)}, 'k', {k}, 'l', l{k}, 'r', r{k})" for k in range(1, MOST_WORDS))
    weakest = F.expr(f"array_min(filter(array({options}), x -> x.score is not null))")
    return wide.select("lang", "words", "phrase", "a", weakest.alias("x")).select("lang", "words", "phrase", "a", "x.l", "x.r", "x.score")


def _covered(frequent: DataFrame) -> DataFrame:
    """Phrases within longer candidates, with the most that one of these occurs: lang, phrase, most."""
    longer = frequent.filter(F.col("words") > 2)
    within = F.expr("""array_distinct(flatten(transform(sequence(2, words - 1),
        n -> transform(sequence(1, words - n + 1), i -> array_join(slice(w, i, n), ' ')))))""")
    rows = longer.withColumn("w", F.split("phrase", " ")).select("lang", "f", F.explode(within).alias("phrase"))
    return rows.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """Each language's best phrases of docs (lang, text): lang, rank, phrase, a, l, r, n, score.

    A null text is empty and a null lang is `und`; empty texts have no phrases. Texts of any length are read
    whole, in slices that share three words; only a single word is never cut. Repeated rows count again.
    Equal scores are ranked by count and then by the phrase's bytes, and equal cuts by the shorter first part.
    An empty table gives no rows; other columns are ignored, whatever their names.
    """
    if top < 1:
        raise ValueError("top must be positive")
    spark = docs.sparkSession
    frequent = frequent_phrases(docs, least, bits, chunk)
    scored, covered = _scored(frequent), _covered(frequent)
    kept = scored.join(covered.hint("merge"), ["lang", "phrase"], "left")
    hundred, share = F.lit(100).cast("decimal(3,0)"), F.lit(SUBSUMED).cast("decimal(3,0)")
    wide = [F.col(c).cast("decimal(20,0)") for c in ("most", "a")]
    kept = kept.filter(F.col("most").isNull() | (hundred * wide[0] < share * wide[1])).drop("most", "words")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of each of many parts of a language, then the best of these.
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(spark)))
    some = kept.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    some = some.filter(F.col("_place") <= top).drop("_part", "_place")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = frequent.filter(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    out = staged(ranked.join(totals.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    unstage(frequent)
    return out


def oracle_sql() -> str:
    """DuckDB SQL for collocations() over documents."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS t FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), places AS (
    SELECT lang, w, x.n AS k, unnest(range(1, len(w) - x.n + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) x(n)
), counts AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= {LEAST}
), cuts AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM counts WHERE k > 1
), scored AS (
    SELECT a.lang, a.phrase, a.k, a.f AS a, l.f AS l, r.f AS r, a.c,
        (({SCALE}::HUGEINT * a.f) // (l.f::HUGEINT + r.f))::BIGINT AS score
    FROM cuts a
    JOIN counts l ON l.lang = a.lang AND l.phrase = array_to_string(a.w[1:a.c], ' ')
    JOIN counts r ON r.lang = a.lang AND r.phrase = array_to_string(a.w[a.c + 1:], ' ')
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_lengths AS (
    SELECT lang, k, f, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM counts WHERE k > 2
), inner_places AS (
    SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS i FROM inner_lengths
), covered AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS most FROM inner_places GROUP BY ALL
), kept AS (
    SELECT s.* FROM weakest s LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase
    WHERE c.most IS NULL OR 100::HUGEINT * c.most < {SUBSUMED}::HUGEINT * s.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
