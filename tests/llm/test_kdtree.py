import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm import kdtree
from residua.session import table


def brute(rows, k, every):
    kept = {}
    for i, x in rows:
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x):
            code = [math.floor(v * 64) for v in x]
            kept[i] = max(kept.get(i, code), code)
    out = []
    for q in sorted(kept):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(kept[q], v, strict=False)), i) for i, v in kept.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def got(df):
    return sorted(map(tuple, df.collect()))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 3), st.integers(1, 8), st.integers(0, 99))
def test_tree_alone(n, dim, k, seed):
    rng = np.random.default_rng(seed)
    vectors, ids = rng.integers(-3, 4, (n, dim)), rng.permutation(n)
    tree = kdtree.Tree(vectors, ids, leaf=4)
    found = tree.search(vectors, ids, k, np.full(n, kdtree.LOWEST))
    for q, (i, s) in enumerate(found):
        want = sorted((-int(vectors[q] @ vectors[j]), int(ids[j])) for j in range(n) if j != q)[:k]
        assert sorted((-int(b), int(a)) for a, b in zip(i, s, strict=True)) == want


@pytest.mark.parametrize("shard,block", [(8192, 256), (60, 7)])
def test_whole_table(spark, sf_dir, monkeypatch, shard, block):
    monkeypatch.setattr(kdtree, "SHARD", shard)
    monkeypatch.setattr(kdtree, "BLOCK", block)
    rows = table(spark, sf_dir, "embeddings")
    want = brute([(r.vec_id, [float(x) for x in r.embedding]) for r in rows.collect()], 20, 20)
    assert got(kdtree.top_k(rows)) == sorted(want)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [float("nan"), 1.0]), (None, [9.0, 9.0]), (-20, [0.5, -1.0])]
    rows += [(6, [None, 1.0]), (7, [float("inf"), 0.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (40, [-3.0, 0.0]), (41, [3e5, 3e5])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, score int")
    assert got(kdtree.top_k(df, k=3)) == sorted(brute(rows, 3, 20))
    assert got(kdtree.top_k(df)) == sorted(brute(rows, 20, 20))
    assert got(kdtree.top_k(df.limit(0))) == []


@settings(max_examples=80, deadline=None)
@given(st.integers(2, 40), st.integers(1, 4), st.integers(1, 5), st.integers(0, 99), st.sampled_from([10, 20, 27, 30, 31, 33, 45, 62]))
def test_large_components_are_exact(n, dim, k, seed, bits):
    rng = np.random.default_rng(seed)
    vectors, ids = rng.integers(-(1 << bits), 1 << bits, (n, dim)), rng.permutation(n)
    vectors[rng.random((n, dim)) < 0.3] //= 1 << (bits // 2)
    found = kdtree.Tree(vectors, ids, leaf=4).search(vectors, ids, k, np.full(n, kdtree.LOWEST))
    plain = vectors.tolist()
    for q, (i, s) in enumerate(found):
        scored = [(-sum(a * b for a, b in zip(plain[q], v, strict=True)), int(ids[j])) for j, v in enumerate(plain) if j != q]
        assert sorted((-int(b), int(a)) for a, b in zip(i, s, strict=True)) == sorted(scored)[:k]


def test_tables_with_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-(1 << 25), 1 << 25, 3) / 64]) for i in range(45)]
    rows += [(100, [4e7, 1.0, 0.0]), (101, [4e7, 5.5, 3e4]), (102, [33554433.0, 33554434.0, 0.0]), (120, [3e7, 100.0, 0.0])]
    assert got(kdtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))) == sorted(brute(rows, 20, 20))
    for large in ([1e300], [1e12, 1e12]):
        bad = spark.createDataFrame([(0, large), (1, large), (2, [0.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="64-bit integer"):
            kdtree.top_k(bad).collect()
    small = spark.createDataFrame([(0, [1e12]), (1, [-1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit integer"):
        kdtree.top_k(small).collect()
