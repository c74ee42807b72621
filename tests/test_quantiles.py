import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.operators.quantiles import exact_quantiles

AT = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p999": 0.999, "most": 1.0, "low": 0.5}


def brute(values):
    v = sorted(math.inf if x != x else x for x in values if x is not None)
    out = {}
    for name, p in AT.items():
        if name == "low":
            out[name] = v[max(math.ceil(len(v) * p) - 1, 0)]
        else:
            a, b = v[math.floor((len(v) - 1) * p)], v[math.ceil((len(v) - 1) * p)]
            out[name] = a if a == b else a + (b - a) * ((len(v) - 1) * p % 1)
    return len(v), out


def sets():
    r = random.Random(3)
    yield "normal", [r.gauss(0, 1) for _ in range(700)]
    yield "clustered", [2.0 ** -r.randint(0, 60) * r.choice([1, -1]) for _ in range(400)] + [0.0, -0.0]
    yield "equal", [7.5] * 300
    yield "nearly equal", [1.0] * 200 + [math.nextafter(1.0, 2)] * 3
    yield "extreme", [1.7e308, -1.7e308, 5e-324, math.inf, -math.inf, math.nan, None, 0.0] * 9
    yield None, [float(k) for k in range(90)]
    yield "one", [3.0]


def test_against_sorting(spark):
    rows = [(k, v) for k, values in sets() for v in values] + [("nothing", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", AT, ("low",), cells=256, small=20).collect()}
    assert set(got) == {k for k, _ in sets()}
    for k, values in sets():
        n, want = brute(values)
        assert got[k].n == n
        for name, x in want.items():
            assert got[k][name] == pytest.approx(x, rel=1e-12), (k, name)


def test_without_keys_and_empty(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert exact_quantiles(df, [], "v", {"p50": 0.5, "p90": 0.9}, small=10).collect() == [(1000, 499.5, 899.1)]
    assert exact_quantiles(df.filter("v < 0"), [], "v", {"p50": 0.5}).collect() == []


def test_a_hot_key_needs_no_task_with_all_its_values(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("k"), F.sin(F.col("id")).alias("v"))
    found = exact_quantiles(df, ["k"], "v", {"p25": 0.25, "p75": 0.75}, small=1000)
    want = np.quantile(np.sin(np.arange(100_000)), [0.25, 0.75])
    assert found.first()[2:] == pytest.approx(want, abs=1e-12)
    assert "percentile" not in found._jdf.queryExecution().toString()
