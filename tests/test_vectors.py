import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.operators import batching, checks, encoder, graph, ledger, lookup, metrics, vectors


def states(spark, groups):
    rows = [(k, p, [float(x) for x in v]) for k, m in groups.items() for p, v in enumerate(m)]
    return spark.createDataFrame(rows, "k string, pos int, state array<double>")


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(4)
    return {"a": rng.normal(size=(5, 3)), "b": rng.normal(size=(1, 3)), "c": rng.normal(size=(8, 3))}


def test_pooling(spark, matrices):
    df = states(spark, matrices)
    mean = {r.k: r["mean"] for r in vectors.mean_pool(df, ["k"]).collect()}
    both = {r.k: r.mean_sd for r in vectors.mean_sd_pool(df, ["k"]).collect()}
    quant = {r.k: r.quantiles for r in vectors.quantile_pool(df, ["k"]).collect()}
    weighted = {r.k: r.pooled for r in vectors.weighted_pool(df.withColumn("w", F.col("pos") + 1), ["k"], "w").collect()}
    var = {r.k: r.variance for r in vectors.gene_mean_var(df, ["k"]).collect()}
    for k, m in matrices.items():
        assert mean[k] == pytest.approx(m.mean(axis=0))
        assert both[k] == pytest.approx(np.concatenate([m.mean(axis=0), m.std(axis=0)]), abs=1e-12)
        q = np.quantile(m, [0.25, 0.5, 0.75], axis=0)
        assert quant[k] == pytest.approx(np.concatenate([m.mean(axis=0), m.std(axis=0), *q]), abs=1e-12)
        assert weighted[k] == pytest.approx(np.average(m, axis=0, weights=np.arange(len(m)) + 1))
        assert var[k] == pytest.approx(m.var(axis=0), abs=1e-12)
    assert var["b"] == [0.0, 0.0, 0.0]


@pytest.mark.parametrize("kind", ["uniform", "triangular", "cosine"])
def test_reconstruct(spark, kind):
    rng = np.random.default_rng(1)
    whole = rng.normal(size=(11, 2))
    starts = encoder.window_starts(11, 5, 2)
    rows = [("x", s, 11, whole[s : s + 5].tolist()) for s in starts] + [("y", 0, 3, whole[:3].tolist())]
    df = spark.createDataFrame(rows, "k string, start int, length int, states array<array<double>>")
    got = {(r.k, r.pos): r.state for r in vectors.reconstruct(df, ["k"], kind).collect()}
    assert len(got) == 14
    assert all(got["x", p] == pytest.approx(whole[p]) for p in range(11)) and all(got["y", p] == pytest.approx(whole[p]) for p in range(3))
    with pytest.raises(Exception, match="not covered"):
        vectors.reconstruct(df.filter("start <> 6"), ["k"], kind).collect()
    w = spark.createDataFrame([("x", s, [1.0] * 5) for s in starts], "k string, start int, weights array<double>")
    total = vectors.position_weights(w, ["k"], kind).agg(F.sum("weight"), F.count("pos")).first()
    assert tuple(total) == pytest.approx((1.0, 11))


def test_spectrum_and_pairs(spark):
    m = np.random.default_rng(2).normal(size=(40, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, v array<double>")
    s = np.linalg.svd(m - m.mean(axis=0), compute_uv=False) ** 2
    r = vectors.spectrum(df, "v", 6).first()
    assert (r.effective_rank, r.top5_fraction) == pytest.approx((s.sum() ** 2 / (s**2).sum(), s[:5].sum() / s.sum()))
    pairs = vectors.pairwise_cosine(df, "id", "v").collect()
    assert len(pairs) == 780
    assert all(p.cosine == pytest.approx(m[p.a] @ m[p.b] / np.linalg.norm(m[p.a]) / np.linalg.norm(m[p.b])) for p in pairs)
    with pytest.raises(ValueError):
        vectors.pairwise_cosine(df, "id", "v", most=10)
    near = vectors.medoid(df.withColumn("g", F.lit(1)), "g", "id", "v").first()
    distance = np.linalg.norm(m[:, None] - m[None], axis=2).sum(axis=1)
    assert near.id == int(distance.argmin()) and near.total_distance == pytest.approx(distance.min())
    swe = vectors.wasserstein_features(states(spark, {"a": m[:9, :3], "b": m[9:12, :3]}), "k", m[12:17, :3], np.eye(3)).collect()
    assert {len(r.features) for r in swe} == {3}
    same = vectors.wasserstein_features(states(spark, {"a": m[:5, :3]}), "k", m[:5, :3], np.eye(3)).first()
    assert same.features == pytest.approx([0, 0, 0])


def slow_pagerank(m, rounds):
    n = len(m)
    x = [1 / n] * n
    for _ in range(rounds):
        y = [0.15 / n] * n
        for i in range(n):
            total = sum(m[i])
            for j in range(n):
                y[j] += 0.85 * x[i] * (m[i][j] / total if total else 1 / n)
        x = y
    return x


def test_pagerank(spark):
    m = np.random.default_rng(17).random((12, 12))
    m[3] = 0
    score, rounds, settled = graph.pagerank(m, tolerance=1e-12)
    assert settled and score == pytest.approx(slow_pagerank(m.tolist(), rounds))
    w = graph.residue_weights(m)
    assert len(w) == 10 and w.sum() == pytest.approx(1, abs=1e-6) and np.isfinite(w).all()
    assert not graph.pagerank(m, rounds=1)[2]
    with pytest.raises(ValueError):
        graph.pagerank(np.ones((2, 3)))
    edges = spark.createDataFrame([("g", i, j, float(m[i, j])) for i in range(12) for j in range(12)], "k string, i long, j long, w double")
    many = {r.node: r for r in graph.grouped_pagerank(edges, "k").collect()}
    settled_score, n_rounds, _ = graph.pagerank(m)
    assert [many[k].score for k in range(12)] == pytest.approx(settled_score.tolist()) and many[0].rounds == n_rounds and many[0].converged
    trimmed = graph.grouped_pagerank(edges, "k", trim=True).collect()
    assert sum(r.score for r in trimmed) == pytest.approx(1) and len(trimmed) == 10
    large = {r.node: r.score for r in graph.edge_pagerank(edges).collect()}
    assert [large[k] for k in range(12)] == pytest.approx(settled_score.tolist())
    assert graph.edge_pagerank(edges.limit(0)).count() == 0


def test_attention(spark):
    a = np.random.default_rng(0).random((2, 3, 4, 4))
    rows = [(la, h, i, j, float(a[la, h, i, j])) for la in range(2) for h in range(3) for i in range(4) for j in range(4)]
    df = spark.createDataFrame(rows, "layer int, head int, i int, j int, w double")
    got = {(r.i, r.j): r.w for r in graph.reduce_attention(df, []).collect()}
    top = graph.reduce_attention_array(a)
    assert all(got[i, j] == top[i, j] for i in range(4) for j in range(4))
    with pytest.raises(ValueError):
        graph.reduce_attention_array(a[0])


def batches(spark, rows, tokens, size):
    df = spark.createDataFrame(rows, "key string, length int")
    out = {}
    for r in sorted(batching.length_batches(df, "key", "length", tokens, size).collect(), key=lambda r: r.place):
        out.setdefault(r.batch_id, []).append(r.key)
    return list(out.values())


def test_length_batches(spark):
    assert batches(spark, [("c", 100), ("a", 50), ("b", 75)], 160, 2) == [["a", "b"], ["c"]]
    assert batches(spark, [("z", 100), ("x", 100), ("y", 100)], 1000, 2) == [["x", "y"], ["z"]]
    assert batches(spark, [("a", 5000), ("b", 1)], 10, 3) == [["b"], ["a"]]
    rows = [(f"k{i:03d}", (i * 37) % 200 + 1) for i in range(120)]
    want = [[h for _, h, _ in b] for b in encoder.greedy(sorted((n, k, "") for k, n in rows), 900, 7)]
    assert batches(spark, rows, 900, 7) == want
    with pytest.raises(ValueError):
        batching.length_batches(spark.range(1), "id", "id", 0, 1)


def test_shards_and_samples(spark):
    rows = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("sequence_hash"), (F.col("id") % 90).cast("int").alias("n"))
    order = sorted(r.sequence_hash for r in rows.collect())
    sharded = batching.assign_shards(rows, size=300)
    assert {r.sequence_hash: r.shard_id for r in sharded.collect()} == {h: k // 300 for k, h in enumerate(order)}
    manifest = batching.shard_manifest(sharded).orderBy("shard_id").collect()
    assert [m.row_count for m in manifest] == [300, 300, 300, 100] and manifest[3].last_sequence_hash == order[-1]
    entry = manifest[1].asDict()
    one = sharded.filter("shard_id = 1").withColumn("amino_acid_sequence", F.lit("M"))
    checks.enforce(checks.shard_matches(one, entry))
    with pytest.raises(ValueError, match="row count"):
        checks.enforce(checks.shard_matches(one, entry | {"row_count": 299}))
    sample = batching.stratified_sample(rows, "n", "sequence_hash", [(0, 9), (10, 19)], 50).collect()
    assert len({r.sequence_hash for r in sample}) == 50
    assert sum(0 <= r.n <= 9 for r in sample) >= 25 and sum(10 <= r.n <= 19 for r in sample) >= 25


def test_features_bank_and_lookup(spark):
    class Fussy(encoder.HashEncoder):
        def encode(self, sequences):
            if any("X" in s for s in sequences):
                raise RuntimeError("no X")
            return super().encode(sequences)

    seqs = {"h1": "MKV", "h2": "MXV", "h3": "MAGIC" * 300, "h4": "", "h5": "MKL"}
    df = spark.createDataFrame(list(seqs.items()), "sequence_hash string, amino_acid_sequence string")
    bank = encoder.extract_features(df, Fussy).cache()
    got = {r.sequence_hash: r for r in bank.collect()}
    assert {k: r.status for k, r in got.items()} == {"h1": "ok", "h2": "failed", "h3": "ok", "h4": "failed", "h5": "ok"}
    assert "no X" in got["h2"].error and got["h3"].chunk_count == 2 and got["h3"].length == 1500
    (states, weights), = encoder.HashEncoder().encode(["MKV"])
    assert got["h1"]["mean"] == pytest.approx(states.mean(axis=0), abs=1e-6)
    assert got["h1"].parti == pytest.approx(graph.residue_weights(weights) @ states, abs=1e-6)
    checks.enforce(checks.bank_checks(bank.filter("status = 'ok'"), {"mean": 16, "std": 16, "parti": 16}, 3))
    bad = checks.bank_checks(bank, {"mean": 16}, 4).filter("not ok").collect()
    assert {r.check for r in bad} == {"status ok", "mean size", "mean finite", "row count"} or len(bad) >= 3
    assert not checks.bank_checks(bank, {"other": 3}).first().ok
    done = ledger.completed(bank, ["mean", "std", "parti"])
    assert {r.sequence_hash for r in ledger.pending(df, done).collect()} == {"h2", "h4"}
    assert ledger.completed(bank, ["missing"]).count() == 0
    summary = spark.createDataFrame([("G1",), ("G2",), ("G3",)], "vcc_gene_name string")
    relations = spark.createDataFrame([("G1", "h1", "MANE Select"), ("G1", "h5", ""), ("G2", "h2", "")], "vcc_gene_name string, sequence_hash string, mane_status string")
    look = lookup.VectorLookup(summary, relations, bank)
    assert [look.state(g) for g in ("G1", "G2", "G3", "G9")] == [lookup.FOUND, lookup.NOT_EXTRACTED, lookup.NO_SEQUENCE, lookup.UNKNOWN]
    assert look.has_vector("G1") and look.canonical_vector("G1") == got["h1"]["mean"] and look.canonical_vector("G2") is None
    want = (np.array(got["h1"]["mean"]) + np.array(got["h5"]["mean"])) / 2
    assert look.gene_vector("G1") == pytest.approx(want, abs=1e-6) and look.gene_vector("G2") is None
    assert look.isoforms("G1").count() == 2 and look.isoform_vector("h5") == got["h5"]["mean"] and look.isoform_vector("h2") is None
    spread = np.sum((np.array(got["h5"]["mean"]) - np.array(got["h1"]["mean"])) ** 2) / 2
    assert {r.vcc_gene_name: r.diversity for r in look.diversity().collect()} == {"G1": pytest.approx(spread, rel=1e-4)}


def test_ledger(spark):
    rows = [("a", 1, "failed"), ("a", 2, "ok"), ("b", 1, "ok"), ("b", 2, "failed"), ("c", 1, "failed")]
    attempts = spark.createDataFrame(rows, "sequence_hash string, attempt int, status string")
    assert {r.sequence_hash: r.status for r in ledger.latest(attempts).collect()} == {"a": "ok", "b": "failed", "c": "failed"}
    assert tuple(ledger.progress(attempts).first()) == (1, 2)


def test_metrics(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(6, 4)), rng.normal(size=(6, 4))
    a = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, v array<double>")
    b = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "k int, v array<double>")
    agreement = metrics.vector_agreement(a, b, "k", "v")
    r = {q.k: q for q in agreement.collect()}
    assert all(r[i].max_abs_error == pytest.approx(np.abs(x[i] - y[i]).max()) and r[i].finite for i in range(6))
    least = {q.metric: q for q in metrics.summary(agreement, ["cosine", "relative_l2"]).collect()}
    assert least["cosine"].least == pytest.approx(min(q.cosine for q in r.values()))
    p, q = np.abs(x[0]) / np.abs(x[0]).sum(), np.abs(y[0]) / np.abs(y[0]).sum()
    w = spark.createDataFrame([(p.tolist(), q.tolist())], "p array<double>, q array<double>")
    got = metrics.weight_agreement(w, "p", "q").first()
    m = (p + q) / 2
    js = 0.5 * (p @ np.log(p / m) + q @ np.log(q / m))
    assert (got.pearson, got.js_divergence, got.js_distance) == pytest.approx((np.corrcoef(p, q)[0, 1], js, js**0.5))
    profile = metrics.weight_profile(w, "p").first()
    assert (profile.entropy, profile.effective_positions) == pytest.approx((-(p @ np.log(p)), np.exp(-(p @ np.log(p)))))
    both = a.join(b.withColumnRenamed("v", "u"), "k").withColumn("g", F.lit(1))
    e = metrics.reconstruction_error(both, ["g"], "v", "u").first()
    cos = sorted(q.cosine for q in r.values())
    assert e.median_cosine == pytest.approx(cos[2]) and e.rmse == pytest.approx(np.sqrt(((x - y) ** 2).mean()))


def test_expectations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", None)], "k string, n int")
    found = {r.check: (r.failures, r.ok) for r in checks.Expectations(("k", "n"), ("k",), ("k",), 4, {"positive": "n > 0"}).evaluate(df).collect()}
    assert found == {"unique k": (1, False), "filled k": (1, False), "positive": (1, False), "row count": (1, False)}
    assert not checks.Expectations(columns=("z",)).evaluate(df).first().ok
    assert checks.hash_conflicts(df, "k", "n").count() == 1 and checks.orphans(df, df.limit(1), "k").count() == 1
    assert checks.to_json({"b": 1, "a": 2}).index('"a"') < checks.to_json({"b": 1, "a": 2}).index('"b"')


def test_pagerank_of_many_graphs(spark):
    """Graphs of unlike size and speed, parallel edges, dangling and lone nodes, and a null key, against numpy."""
    r = np.random.default_rng(5)
    graphs = {"a": r.random((9, 9)), "cycle": np.roll(np.eye(6), 1, axis=1), "chain": np.eye(7, k=1), None: r.random((3, 3)) * (r.random((3, 3)) > 0.4), "one": np.ones((1, 1))}
    graphs[None][2, 2] = 1.0
    graphs["a"][4] = 0
    rows = [(k, i, j, w / 2) for k, m in graphs.items() for (i, j), w in np.ndenumerate(m) for _ in range(2) if w or i == len(m) - 1]
    edges = spark.createDataFrame([(k, int(i), int(j), float(w)) for k, i, j, w in rows], "name string, i long, j long, w double")
    got = {}
    for x in graph.grouped_pagerank(edges, "name").collect():
        got.setdefault(x.name, {})[x.node] = x
    assert set(got) == set(graphs)
    for k, m in graphs.items():
        score, rounds, settled = graph.pagerank(m)
        assert [got[k][n].score for n in range(len(m))] == pytest.approx(score.tolist(), abs=1e-9)
        assert {(x.rounds, x.converged) for x in got[k].values()} == {(rounds, settled)}
    short = graph.grouped_pagerank(edges.filter("name = 'a'"), "name", rounds=3).collect()
    assert [x.score for x in sorted(short, key=lambda x: x.node)] == pytest.approx(graph.pagerank(graphs["a"], rounds=3)[0].tolist(), abs=1e-9)
    assert {(x.rounds, x.converged) for x in short} == {(3, False)}
    assert graph.grouped_pagerank(edges.limit(0), "name").count() == 0


def test_diagnostics(spark):
    rows = [("f", [3.0, 4.0], 10, 1), ("f", [6.0, 8.0], 20, 3), ("f", [9.0, 12.0], 30, 1), ("g", [1.0, 0.0], 5, 2)]
    df = spark.createDataFrame(rows, "k string, vector array<double>, n int, size int")
    got = {r.k: r for r in metrics.norm_length(df, ["k"], "vector", "n").collect()}
    assert got["f"].mean_norm == 10 and got["f"].norm_length_correlation == pytest.approx(1) and got["g"].norm_length_correlation is None
    control = {r.k: r for r in vectors.chunk_control(df, ["k"]).collect()}
    assert control["f"].control == pytest.approx([6.0, 8.0]) and control["f"].plain == pytest.approx([6.0, 8.0]) and control["g"].control == [1.0, 0.0]
    a = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 2.0])], "k string, v array<double>")
    b = spark.createDataFrame([("x", [1.0, 0.1]), ("y", [0.0, 2.0])], "k string, v array<double>")
    r = metrics.repeatability(a, b, "k", "v", 0.05).first()
    assert (r.n, r.within) == (2, 1) and r.max_abs_diff == pytest.approx(0.1) and r.mean_abs_diff == pytest.approx(0.025)
    assert metrics.repeatability(a.limit(0), b, "k", "v", 0.05).first().n == 0
