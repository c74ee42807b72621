import numpy as np
import pytest
from pyspark.sql import functions as F

from residua.sources import npy, sinks


def matrix_of(spark, n):
    rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("sequence_hash"), F.array(F.col("id") / 2, -F.col("id"), F.lit(0.25)).alias("mean"))
    return rows.repartition(5)


def test_bytes_are_numpys(spark, tmp_path):
    bank = matrix_of(spark, 1000)
    rows = sorted(bank.collect())
    for _ in range(2):  # the second run replaces the first
        sinks.export_npy(bank, "mean", str(tmp_path / "new" / "mean"))
    np.save(tmp_path / "want.npy", np.array([r["mean"] for r in rows], dtype=np.float32))
    np.save(tmp_path / "want_hashes.npy", np.array([r.sequence_hash for r in rows], dtype="U64"))
    for end in (".npy", "_hashes.npy"):
        assert (tmp_path / "new" / f"mean{end}").read_bytes() == (tmp_path / f"want{end}").read_bytes()
    assert sorted(p.name for p in (tmp_path / "new").iterdir()) == ["mean.npy", "mean_hashes.npy"]


def test_ranges_of_rows_and_columns(spark, tmp_path):
    path = str(tmp_path / "m")
    np.save(f"{path}.npy", np.arange(70, dtype=np.float32).reshape(10, 7))
    np.save(f"{path}_hashes.npy", np.array([f"h{k}" for k in range(10)], dtype="U64"))
    df = npy.read_npy(spark, f"file://{path}", ("row", "sequence_hash", "vector"), rows=3)
    assert df.rdd.getNumPartitions() == 4
    assert [(r.row, r.sequence_hash, r.vector[0]) for r in sorted(df.collect())] == [(k, f"h{k}", 7.0 * k) for k in range(10)]
    (tmp_path / "m.npy").rename(tmp_path / "kept.npy")
    np.save(f"{path}.npy", np.zeros((10, 0), np.float32))  # vectors that aren't asked for aren't read
    assert sorted(r.sequence_hash for r in npy.read_npy(spark, path, ("sequence_hash",)).collect()) == [f"h{k}" for k in range(10)]


def test_a_write_that_fails_leaves_the_older_files(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.export_npy(matrix_of(spark, 5), "mean", path)
    before = (tmp_path / "m.npy").read_bytes()
    uneven = matrix_of(spark, 6).withColumn("mean", F.when(F.col("mean")[0] > 2, F.array(F.lit(1.0))).otherwise(F.col("mean")))
    with pytest.raises(Exception, match="without 3 numbers"):
        sinks.export_npy(uneven, "mean", path)
    rows = spark.createDataFrame([(0, "a", [1.0])], npy.SCHEMA)
    with pytest.raises(Exception, match="1 rows written, 2 expected"):
        npy.write_npy(rows, path, 2, 1)
    assert (tmp_path / "m.npy").read_bytes() == before and sorted(p.name for p in tmp_path.iterdir()) == ["m.npy", "m_hashes.npy"]
    with pytest.raises(ValueError, match="mounted"):
        npy.local("s3://bucket/m")


def test_no_rows(spark, tmp_path):
    sinks.export_npy(matrix_of(spark, 3).limit(0), "mean", str(tmp_path / "m"))
    assert np.load(tmp_path / "m.npy").shape == (0, 0)
    assert npy.read_npy(spark, str(tmp_path / "m")).count() == 0
