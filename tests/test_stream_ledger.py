"""Timers of the stream ledger, in a query that runs on."""

import time

from residua.streaming import ledger

SCHEMA = "key string, attempt long, at long, ok boolean"


def test_failed_keys_come_due(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    changes = ledger.ledger_changes(spark.readStream.schema(SCHEMA).parquet(folder), retry_ms=1, most_attempts=2)

    def step(*rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def due():
        return sorted((r.key, r.attempts) for r in ledger.due(changed()).collect())

    def changed():
        return spark.read.schema(ledger.CHANGES).parquet(out) if (tmp_path / "out" / "_spark_metadata").exists() else spark.createDataFrame([], ledger.CHANGES)

    def until(holds):
        """A query with timers always has a next batch, so its end can't be waited for."""
        limit = time.time() + 90
        while not holds() and time.time() < limit:
            time.sleep(1)
        assert holds()

    def start():
        with ledger.state_store(spark):
            return changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).start()

    query = start()
    try:
        step(("a", 1, 1, False), ("b", 2, 2, False), ("c", 3, 3, True))
        until(lambda: due() == [("a", 1), ("b", 1)])
    finally:
        query.stop()
    query = start()  # goes on from its checkpoint
    try:
        step(("b", 4, 4, True), ("a", 5, 5, None), ("a", 1, 1, False))  # the last one came before
        until(lambda: due() == [])  # b has succeeded, a has had its two attempts
    finally:
        query.stop()
    now = sorted(map(tuple, ledger.current(changed()).collect()))
    assert now == [("a", "failed", 5, 5, 2, 2), ("b", "ok", 4, 4, 2, 1), ("c", "ok", 3, 3, 1, 0)]
