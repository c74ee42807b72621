import numpy as np
import pyarrow as pa
import pytest

from residua.operators import medoids, vectors
from residua.operators.medoids import exact_medoid


def brute(m):
    best = []
    for at in range(0, len(m), 500):
        best.append(np.sqrt(np.maximum(((m[at : at + 500, None, :] - m[None]) ** 2).sum(-1), 0)).sum(1))
    sums = np.concatenate(best)
    return int(sums.argmin()), float(sums.min())


def test_groups_of_unlike_size(spark):
    r = np.random.default_rng(2)
    sets = {"a": r.normal(size=(300, 3)), None: r.normal(size=(90, 5)), "one": np.ones((1, 2)), "same": np.ones((40, 2))}
    rows = [(g, k, [float(x) for x in v]) for g, m in sets.items() for k, v in enumerate(m)] + [("a", 999, None)]
    df = spark.createDataFrame(rows, "g string, k long, v array<double>")
    got = {x.g: x for x in exact_medoid(df, "g", "k", "v", block=16).collect()}
    assert set(got) == set(sets)
    for g, m in sets.items():
        k, s = brute(m)
        assert got[g].total_distance == pytest.approx(s)
        assert got[g].k == (k if g != "same" else got[g].k) and got[g].measured <= len(m)
    assert got["a"].measured < 300
    known = df.filter("g is not null and v is not null")
    assert {(x.g, x.k) for x in vectors.medoid(known.filter("g = 'a'"), "g", "k", "v").collect()} == {("a", got["a"].k)}
    assert exact_medoid(df.limit(0), "g", "k", "v").count() == 0


def test_twenty_thousand_in_one_group(spark):
    m = np.random.default_rng(4).normal(size=(20_000, 2)).round(6)
    df = spark.createDataFrame([("g", k, v) for k, v in enumerate(m.tolist())], "g string, k long, v array<double>")
    r = exact_medoid(df, "g", "k", "v").first()
    sums = np.array([np.sqrt(((m - m[k]) ** 2).sum(1)).sum() for k in np.argsort((m**2).sum(1))[:400]])  # the medoid lies near the middle
    assert r.total_distance == pytest.approx(sums.min()) and r.measured < 2000


def test_few_rounds_where_bounds_prune_little(spark, monkeypatch):
    m = np.random.default_rng(5).normal(size=(1500, 32))
    df = spark.createDataFrame([(None, k, v) for k, v in enumerate(m.tolist())], "g string, k long, v array<double>")
    calls, plain = [], medoids.staged
    monkeypatch.setattr(medoids, "staged", lambda d, name: calls.append(name) or plain(d, name))
    r = exact_medoid(df, "g", "k", "v").first()
    k, s = brute(m)
    assert (r.k, r.total_distance) == (k, pytest.approx(s)) and calls.count("medoid-block") <= 8


def test_rounds_grow_with_the_group(spark, monkeypatch):
    m = np.random.default_rng(6).normal(size=(4000, 24))
    df = spark.createDataFrame([("g", k, v) for k, v in enumerate(m.tolist())], "g string, k long, v array<double>")
    calls, plain = [], medoids.staged
    monkeypatch.setattr(medoids, "staged", lambda d, name: calls.append((name, d.columns)) or plain(d, name))
    r = exact_medoid(df, "g", "k", "v").first()
    k, s = brute(m)
    assert (r.k, r.total_distance) == (k, pytest.approx(s, rel=1e-12))
    assert sum(name == "medoid-block" for name, _ in calls) <= 3 and not any("d" in c for name, c in calls if name != "medoid-groups")  # no distances


def test_copies_and_odd_numbers(spark):
    r = np.random.default_rng(7)
    near = r.normal(size=(1, 6)) + 1e-6 * r.normal(size=(400, 6))
    sets = {
        "copies": np.concatenate([r.normal(size=(200, 4)), np.zeros((300, 4))]),
        "near": np.concatenate([near, r.normal(size=(900, 6)), [[1e4] * 6]]) + 1e6,
        "far": r.normal(size=(50, 3)) * 1e200,
        "small": r.normal(size=(50, 3)) * 1e-150,
    }
    rows = [(g, k, v) for g, m in sets.items() for k, v in enumerate(m.tolist())]
    odd = [("nan", 4, [1.0, 2.0]), ("nan", 3, [float("nan"), 1.0]), ("nan", 5, [0.0, 1.0]), ("inf", 2, [float("inf")]), ("inf", 8, [1.0]), ("inf", 7, [3.0])]
    got = {x.g: x for x in exact_medoid(spark.createDataFrame(rows + odd, "g string, k long, v array<double>"), "g", "k", "v").collect()}
    for g in ("copies", "near", "small"):
        k, s = brute(sets[g])
        assert (got[g].k, got[g].total_distance) == (k, pytest.approx(s, rel=1e-11)), g
    assert got["copies"].k == 200 and got["copies"].measured <= 201  # copies are measured once
    assert (got["nan"].k, str(got["nan"].total_distance)) == (3, "nan")
    assert (got["inf"].k, got["inf"].total_distance) == (7, np.inf) and (got["far"].k, got["far"].total_distance) == (0, np.inf)
    floats = spark.createDataFrame([("g", k, v) for k, v in enumerate(sets["copies"].tolist())], "g string, k long, v array<float>")
    k, s = brute(sets["copies"].astype(np.float32).astype(np.float64))
    assert exact_medoid(floats, "g", "k", "v").first()[1:3] == (k, pytest.approx(s))
    with pytest.raises(Exception, match="unlike length"):
        exact_medoid(spark.createDataFrame([("g", 1, [1.0]), ("g", 2, [1.0, 2.0])], "g string, k long, v array<double>"), "g", "k", "v").collect()


@pytest.mark.parametrize("offset", [0.0, 1e5])
def test_bounds_lie_below_sums(offset):
    r = np.random.default_rng(8)
    m = np.concatenate([r.normal(size=(150, 5)), 0.1 * r.normal(size=(60, 5)) + 2]) + offset
    w = r.integers(1, 4, size=len(m)).astype(float)
    sums = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1)) @ w
    row = lambda x, kind: pa.array([x.tolist()], kind)[0]
    x, v = pa.list_(pa.list_(pa.float64())), pa.list_(pa.float64())
    keys, weights, all_ = pa.array([list(range(len(m)))]), row(w, v), row(m, x)

    def run(of, piece):
        of.piece(0, *piece)
        bound = [np.array(b[0].as_py()) for _, b in of.pack(keys, weights, all_)]
        return bound[0] if bound else np.array(next(iter(of.end()))[1][0].as_py())

    middle = m[:50].mean(axis=0)
    moments = run(medoids._Moments(), (None, row(middle, v)))
    low = run(medoids._ByMoments(), (None, row(np.concatenate([[5], middle, moments]), v)))
    known = run(medoids._Sums(slopes=True), (row(m[::20], x), None))
    assert known[:11] == pytest.approx(sums[::20], rel=1e-9)
    tangents = run(medoids._ByTangents(), (row(m[::20], x), row(np.concatenate([[w.sum()], known]), v)))
    for bound in (low, tangents):
        assert (bound <= sums * (1 + 1e-12)).all() and np.median(bound / sums) > 0.8
