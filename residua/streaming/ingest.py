"""Incremental extraction: new files in a folder become rows of a bank, each sequence once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from residua.operators.ledger import pending


def ingest_available(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    bank: str,
    checkpoint: str,
    process: Callable[[DataFrame], DataFrame],
    key: str = "sequence_hash",
) -> None:
    """Process all files that the checkpoint hasn't seen, then stop.

    Each micro-batch drops keys that repeat in it or that the bank holds, processes the rest, and appends
    under its own batch folder, so a batch that is run again replaces what it wrote before. Where process
    gives a column status, only rows that are ok count as held: a key that failed is tried again when it
    comes again, and ledger.latest(bank, key, "batch") gives the state of each key.
    """
    source = spark.readStream.schema(schema).parquet(folder)

    def land(batch: DataFrame, number: int) -> None:
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(bank)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        work = batch.dropDuplicates([key])
        earlier = [
            s.getPath().toString()
            for s in (fs.listStatus(root) if fs.exists(root) else [])
            if s.getPath().getName().startswith("batch=") and s.getPath().getName() != f"batch={number}"
        ]
        if earlier:
            held = spark.read.parquet(*earlier)
            if "status" in held.columns:
                held = held.filter(F.col("status") == "ok")
            work = pending(work, held, key)
        process(work).write.mode("overwrite").parquet(f"{bank}/batch={number}")

    query = source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
