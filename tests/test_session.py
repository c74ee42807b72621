import os

import pytest

from residua import session


def test_staged_tables_live_in_the_shared_folder(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    kept = session.staged(df, "numbers")
    assert kept.columns == ["k"] and kept.count() == 10
    root = session.shared_dir(spark)
    folder = kept.inputFiles()[0].removeprefix("file:").lstrip("/")
    assert "numbers-" in folder and os.path.isdir("/" + os.path.dirname(folder))
    session.unstage(kept)
    assert not os.path.exists("/" + os.path.dirname(folder))
    assert session.shared_dir(spark) == root
    empty = session.staged(df.limit(0), "none")
    assert empty.count() == 0 and empty.columns == ["k"]


def test_batches_are_bounded_but_not_raised(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "50")
        session.bound_arrow_batches(spark)
        assert spark.conf.get(key) == "50"
        spark.conf.set(key, "10000")
        session.bound_arrow_batches(spark)
        assert int(spark.conf.get(key)) == session.ARROW_ROWS
    finally:
        spark.conf.set(key, before)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Cluster())
