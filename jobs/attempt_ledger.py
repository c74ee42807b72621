"""Keep a ledger of attempts up to date from a growing log.

    python -m jobs.attempt_ledger --input LOG --output LEDGER --checkpoint STATE [--config FILE]

The log is a folder of Parquet files, or one such file, with event_id, ts, user_id and event_type: one row an attempt at a work
item (user_id). Each run takes the files that have come since the last one and appends the state of every item
that they touch, in folders bucket=K; the last version of an item counts (residua.streaming.ledger.current).
The checkpoint keeps the mark and the state, so a run after a failure goes on where that one stopped, and a
run without new files changes nothing. Files may come in any order, and rows may come again.
"""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.streaming.ledger import current, file_or_folder, ledger_changes, state_store

CONFIG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "attempt_ledger.json")
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"
log = logging.getLogger("jobs.attempt_ledger")


def run(spark: SparkSession, input_path: str, output_path: str, checkpoint: str, config: dict) -> dict:
    """Take in what is new, wait for the stream to end, and return the rows read and written."""
    events = spark.readStream.schema(SCHEMA).parquet(file_or_folder(input_path))
    attempts = events.select(
        F.col("user_id").cast("string").alias("key"),
        F.col("event_id").alias("attempt"),
        F.unix_micros("ts").alias("at"),
        (~F.col("event_type").isin(config["failed_types"])).alias("ok"),
    )
    changes = ledger_changes(attempts).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(config["buckets"])).cast("int"))
    with state_store(spark):
        query = changes.writeStream.format("parquet").partitionBy("bucket").outputMode("append")
        query = query.option("path", output_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    done = [p for p in query.recentProgress if p.numInputRows]
    counts = {"batches": len(done), "rows_read": sum(p.numInputRows for p in done)}
    log.info("read %s: %s", input_path, counts)
    log.info("wrote %s", output_path)
    return counts


def read(spark: SparkSession, output_path: str) -> DataFrame:
    """The ledger as it stands: one row an item."""
    now = current(spark.read.parquet(output_path))
    return now.select(F.col("key").cast("long").alias("user_id"), "status", F.col("attempt").alias("last_event_id"), F.col("at").alias("last_micros"), "attempts", "failures")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="jobs.attempt_ledger", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("input", "output", "checkpoint"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--config", default=CONFIG)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    with open(a.config) as f:
        config = json.load(f)
    spark = SparkSession.builder.appName("attempt-ledger").getOrCreate()
    try:
        print(json.dumps(run(spark, a.input, a.output, a.checkpoint, config)))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
