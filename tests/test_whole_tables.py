"""Queries that SQL can't express, over their whole tables against plain numpy."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from residua.operators import audit, batching, encoder, graph
from residua.plans import numeric
from residua.session import table


def test_spectrum(spark, sf_dir):
    m = np.array([r.embedding for r in table(spark, sf_dir, "embeddings").collect()], dtype=np.float64)
    s = np.linalg.svd(m - m.mean(axis=0), compute_uv=False) ** 2
    r = numeric.vec_spectrum(spark, sf_dir).first()
    assert r.n == len(m)
    assert (r.effective_rank, r.top5_fraction) == pytest.approx((s.sum() ** 2 / (s**2).sum(), s[:5].sum() / s.sum()))


def test_extracted_features(spark, sf_dir):
    """Every text encoded alone, window by window, and pooled position by position."""
    model = encoder.HashEncoder()
    got = {r.sequence_hash: r for r in numeric.vec_extract_features(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "benchmark").collect()
    assert set(got) == {hashlib.sha256(r.text.encode()).hexdigest() for r in rows}
    for r in rows:
        n = len(r.text)
        starts = sorted({min(k, max(0, n - 1022)) for k in range(0, max(1, n - 1022 + 894), 894)})
        state, share, total = np.zeros((n, model.dim)), np.zeros(n), np.zeros(n)
        for k in starts:
            h, a = model.encode([r.text[k : k + 1022]])[0]
            w = np.ones(len(h)) if len(starts) == 1 else np.array([max(1 - abs(-1 + 2 * i / (len(h) - 1)), 1 / len(h)) for i in range(len(h))])
            state[k : k + len(h)] += w[:, None] * h
            total[k : k + len(h)] += w
            share[k : k + len(h)] += w * power_iteration(a)[1:-1] / power_iteration(a)[1:-1].sum()
        state /= total[:, None]
        one = got[hashlib.sha256(r.text.encode()).hexdigest()]
        assert (one.status, one.length, one.chunk_count) == ("ok", n, len(starts))
        assert one["mean"] == pytest.approx(state.mean(axis=0), abs=1e-4) and one["std"] == pytest.approx(state.std(axis=0), abs=1e-4)
        assert one["parti"] == pytest.approx((share / share.sum()) @ state, abs=1e-3)


def power_iteration(matrix, rounds=200):
    """PageRank as the dominant vector of the whole transition matrix."""
    n = len(matrix)
    out = matrix.sum(axis=1)
    step = np.full((n, n), 1 / n)
    step[out > 0] = matrix[out > 0] / out[out > 0, None]
    whole = 0.85 * step + 0.15 / n
    score = np.full(n, 1 / n)
    for _ in range(rounds):
        score = score @ whole
    return score


def test_pagerank_by_month(spark, sf_dir):
    orders = {r.o_orderkey: r.o_custkey for r in table(spark, sf_dir, "orders").collect()}
    customers = {r.c_custkey: r.c_nationkey for r in table(spark, sf_dir, "customer").collect()}
    suppliers = {r.s_suppkey: r.s_nationkey for r in table(spark, sf_dir, "supplier").collect()}
    edges = defaultdict(lambda: defaultdict(float))
    for r in table(spark, sf_dir, "lineitem").collect():
        if r.l_orderkey in orders and orders[r.l_orderkey] in customers and r.l_suppkey in suppliers:
            edges[r.l_shipdate.strftime("%Y-%m")][suppliers[r.l_suppkey], customers[orders[r.l_orderkey]]] += r.l_quantity
    got = defaultdict(dict)
    for r in numeric.graph_pagerank_by_month(spark, sf_dir).collect():
        got[r.month][r.node] = r.score
        assert r.converged
    assert set(got) == set(edges)
    for month, weights in edges.items():
        n = max(max(p) for p in weights) + 1
        m = np.zeros((n, n))
        for (i, j), w in weights.items():
            m[i, j] = w
        assert [got[month][k] for k in range(n)] == pytest.approx(power_iteration(m), abs=n * graph.TOLERANCE / (1 - graph.ALPHA))


def test_limits_raise(spark, monkeypatch):
    rows = spark.range(20).selectExpr("id", "'t' AS transcript_type", "id AS kind", "'h' AS protein_sequence_hash")
    monkeypatch.setattr(audit, "MOST_KINDS", 19)
    with pytest.raises(ValueError):
        audit.biotypes(rows, "kind")
    monkeypatch.setattr(batching, "MOST_ROWS", 19)
    with pytest.raises(ValueError):
        batching.length_batches(rows, "id", "kind", 10, 2)
    with pytest.raises(ValueError):
        encoder.window_weights(3, "square")
