"""Make the sequence universe of a table of records, cut into shards for extraction.

    python -m jobs.production_shards --input RECORDS --output FOLDER [--sources A B ...] [--config FILE]

RECORDS is a Parquet table of records with an id, a text and a source (their columns are named in the config).
Written under FOLDER, as Parquet:

* records/source=S: the records of a source with their sequence_hash and length; `issue` says why one has no
  sequence. With --sources only these are made anew, the others stay as they were (dynamic overwrite).
* sequences/length_bin=B: each distinct text of all records once, with the number of its records, the windows
  it is extracted in, and its shard: shard_rows sequences in the order of their hashes.
* manifest: rows, first and last hash and a hash of the contents of each shard.

Every part is overwritten as a whole, so a run after a failure, or again, gives the same. What was written is
checked before the run ends; a hash with two texts raises an error before sequences are written.
"""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators import batching, checks

CONFIG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "production_shards.json")
#: The source of records that name none.
NO_SOURCE = "unknown"
log = logging.getLogger("jobs.production_shards")


def _count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def _records(rows: DataFrame, config: dict) -> DataFrame:
    text = F.col(f"`{config['text']}`").cast("string")
    empty = F.coalesce(text, F.lit("")) == ""
    return rows.select(
        F.coalesce(F.nullif(F.col(f"`{config['source']}`").cast("string"), F.lit("")), F.lit(NO_SOURCE)).alias("source"),
        F.col(f"`{config['id']}`").cast("long").alias("record_id"),
        F.when(~empty, C.sequence_hash(text)).alias("sequence_hash"),
        F.when(~empty, F.length(text)).alias("length"),
        F.when(empty, F.lit("empty_sequence")).otherwise("").alias("issue"),
        F.when(~empty, text).alias("sequence"),
    )


def _write_records(records: DataFrame, path: str, whole: bool) -> None:
    """A source that holds much of the table is spread over files by the hash of its texts."""
    dealt = records.repartition("source", F.pmod(F.xxhash64("sequence_hash", "record_id"), F.lit(64)))
    writer = dealt.sortWithinPartitions("source", "sequence_hash").write.partitionBy("source").mode("overwrite")
    writer.option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(path)


def _sequences(records: DataFrame, config: dict) -> DataFrame:
    """One row a hash, with its shard. Texts of one hash must agree in a second hash and in length.

    Texts are shuffled once: only one goes with a hash, and shards are numbered without them and joined by hash.
    """
    held = records.filter(F.col("sequence_hash").isNotNull())
    second = F.xxhash64("sequence")
    one = held.groupBy("sequence_hash").agg(
        F.min("sequence").alias("sequence"),
        ((F.min(second) == F.max(second)) & (F.min("length") == F.max("length"))).alias("_same"),
        F.min("record_id").alias("first_record_id"),
        F.count(F.lit(1)).alias("records"),
    )
    clash = F.raise_error(F.concat(F.lit("two texts under hash "), F.col("sequence_hash")))
    one = one.withColumn("sequence", F.when(F.col("_same"), F.col("sequence")).otherwise(clash)).drop("_same")
    one = one.withColumn("length", F.length("sequence"))
    windows = F.size(C.chunk_starts(F.col("length"), config["window"], config["overlap"]))
    one = one.withColumn("windows", windows).withColumn("length_bin", C.length_bin(F.col("length")))
    shards = batching.assign_shards(held.select("sequence_hash").distinct(), "sequence_hash", config["shard_rows"]).drop("position")
    return one.join(shards, "sequence_hash")


def run(spark: SparkSession, input_path: str, output_path: str, config: dict, sources: list[str] | None = None) -> dict:
    """Make records, sequences and manifest; returns what was read and written."""
    out = output_path.rstrip("/")
    rows = _records(spark.read.parquet(input_path), config)
    if sources:
        rows = rows.filter(F.col("source").isin(sources))
    _write_records(rows, f"{out}/records", whole=not sources)
    schema = rows.schema
    records = spark.read.schema(schema).parquet(f"{out}/records")
    counts = records.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("issue") != "").alias("empty")).first().asDict()
    log.info("read %s (%s); %s/records: %s", input_path, ", ".join(sources or ["all sources"]), out, counts)

    sharded = _sequences(records, config)
    sharded.sortWithinPartitions("length_bin", "sequence_hash").write.partitionBy("length_bin").mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/sequences")
    written = spark.read.schema(sharded.schema).parquet(f"{out}/sequences")
    checks.enforce(
        checks.Expectations(
            unique=("sequence_hash",), filled=("sequence_hash", "sequence"),
            every_row={"hash of the text": "sequence_hash = sha2(sequence, 256)", "a shard": "shard_id >= 0", "windows": "windows >= 1"},
        ).evaluate(written)
    )
    manifest = batching.shard_manifest(written.select("shard_id", "sequence_hash"))
    manifest.write.mode("overwrite").parquet(f"{out}/manifest")
    counts["shards"] = _count(spark.read.parquet(f"{out}/manifest"))
    totals = written.agg(F.count(F.lit(1)).alias("sequences"), F.sum("records").alias("kept")).first()
    counts |= {"sequences": totals.sequences}
    if (totals.kept or 0) + counts["empty"] != counts["records"]:
        raise ValueError(f"{counts['records']} records, of which {totals.kept} have a sequence and {counts['empty']} none")
    log.info("wrote %s/sequences and %s/manifest: %s", out, out, counts)
    return counts


def read(spark: SparkSession, output_path: str) -> DataFrame:
    """Each record with what was made of it, its texts left out."""
    records = spark.read.parquet(f"{output_path}/records").drop("sequence", "length")
    sequences = spark.read.parquet(f"{output_path}/sequences").drop("sequence")
    manifest = spark.read.parquet(f"{output_path}/manifest").select("shard_id", "row_count", "first_sequence_hash", "content_sha256")
    found = records.join(sequences, "sequence_hash", "left").join(manifest, "shard_id", "left")
    return found.select(
        F.col("source").cast("string"), "record_id", "issue", "sequence_hash", "length", F.col("length_bin").cast("int"), "windows", "records",
        "first_record_id", "shard_id", F.col("row_count").alias("shard_rows"), F.col("first_sequence_hash").alias("shard_first"), F.col("content_sha256").alias("shard_sha256"),
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="jobs.production_shards", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--sources", nargs="*")
    p.add_argument("--config", default=CONFIG)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    with open(a.config) as f:
        config = json.load(f)
    spark = SparkSession.builder.appName("production-shards").getOrCreate()
    try:
        print(json.dumps(run(spark, a.input, a.output, config, a.sources)))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
