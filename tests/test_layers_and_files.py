import hashlib

import numpy as np
import pytest

from residua.operators import graph
from residua.operators.layers import layer_maximum
from residua.sources import annotation


@pytest.mark.parametrize("most", [0, 40, 1 << 20])
def test_running_maximum_is_the_arrays(spark, most):
    r = np.random.default_rng(8)
    sets = {"a": r.normal(size=(7, 3, 5, 5)), None: r.normal(size=(40, 2, 2, 2)), "one": r.normal(size=(1, 1, 3, 3))}
    rows = [(k, m.ravel().tolist()) for k, x in sets.items() for layer in x for m in layer] + [("a", None)]
    got = {r.k: r.weights for r in layer_maximum(spark.createDataFrame(rows, "k string, w array<double>"), "k", "w", most).collect()}
    assert set(got) == set(sets)
    for k, x in sets.items():
        assert got[k] == pytest.approx(graph.reduce_attention_array(x).ravel().tolist(), rel=1e-6)


def test_uneven_layers_raise(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [1.0])], "k string, w array<double>").coalesce(1)
    with pytest.raises(Exception, match="of 2 and of 1 numbers"):
        layer_maximum(rows, "k", "w").collect()
    assert layer_maximum(rows.limit(0), "k", "w").count() == 0


def test_files_of_any_size_are_hashed(spark, tmp_path):
    (tmp_path / "small").write_bytes(b"abc")
    (tmp_path / "empty").write_bytes(b"")
    with open(tmp_path / "large", "wb") as f:  # 3 GB of nought, which takes no room
        f.truncate(3 << 30)
    zeros, want = bytes(1 << 20), hashlib.sha256()
    for _ in range(3 << 10):
        want.update(zeros)
    got = {r.path.rsplit("/", 1)[1]: (r.length, r.sha256) for r in annotation.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {"small": (3, hashlib.sha256(b"abc").hexdigest()), "empty": (0, hashlib.sha256(b"").hexdigest()), "large": (3 << 30, want.hexdigest())}
    assert [r.length for r in annotation.file_hashes(spark, f"file:{tmp_path}/sm*").collect()] == [3]
