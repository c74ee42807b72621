import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.operators import batching
from residua.operators.greedy import batch_ends, greedy_batches


def fold(lengths, max_tokens, max_batch_size):
    out, b, n = [], -1, 0
    for x in lengths:
        if b < 0 or n >= max_batch_size or (x + 2) * (n + 1) > max_tokens:
            b, n = b + 1, 0
        n += 1
        out.append(b)
    return out


def test_ends_are_the_folds(spark):
    r = np.random.default_rng(1)
    for _ in range(100):
        lengths = np.sort(r.integers(0, 40, r.integers(1, 60)))
        tokens, size = int(r.integers(1, 200)), int(r.integers(1, 12))
        ends, at, got = batch_ends(lengths, tokens, size), 0, []
        while at < len(lengths):
            got += [len(set(got))] * (int(ends[at]) - at)
            at = int(ends[at])
        assert got == fold(lengths.tolist(), tokens, size)


def test_many_small_blocks(spark):
    """Blocks of few rows, so that batches run over their ends, in groups of unlike size and one that is null."""
    sizes = {"a": 333, "b": 1, None: 70}
    rows = [(g, f"{(k * 7919) % 1000:04x}{g}", (k * 31) % 53) for g, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "g string, h string, n int")
    found = greedy_batches(df, "h", "n", 150, 7, ["g"], block=16).collect()
    for g, n in sizes.items():
        mine = sorted((r for r in found if r.g == g), key=lambda r: r.place)
        want = sorted((length, h) for x, h, length in rows if x == g)
        assert [(r.n, r.h) for r in mine] == want and [r.place for r in mine] == list(range(n))
        assert [r.batch_id for r in mine] == fold([x for x, _ in want], 150, 7)


def test_the_same_as_the_fold_without_groups(spark):
    df = spark.range(400).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), (F.col("id") * 37 % 101).alias("n"))
    a = batching.length_batches(df, "h", "n", 700, 9)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, greedy_batches(df, "h", "n", 700, 9, block=64).select(*a.columns).collect()))
    assert greedy_batches(df.limit(0), "h", "n", 700, 9).count() == 0
    with pytest.raises(ValueError):
        greedy_batches(df, "h", "n", 0, 9)


def test_more_rows_than_a_fold_takes(spark):
    n = 1_000_000
    df = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), F.when(F.col("id") % 3 == 0, 77).otherwise(F.pmod(F.xxhash64("id"), F.lit(900))).alias("n"))
    found = greedy_batches(df, "h", "n", 8192, 16)
    got = found.select("place", "n", "batch_id").orderBy("place").toArrow()
    lengths = got.column("n").to_numpy()
    assert (got.column("place").to_numpy() == np.arange(n)).all() and (np.diff(lengths) >= 0).all()
    assert got.column("batch_id").to_pylist() == fold(lengths.tolist(), 8192, 16)
