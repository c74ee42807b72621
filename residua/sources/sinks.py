"""Writers: Parquet banks, shards with a manifest, delimited and JSON documents, and atomic publishing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.operators.batching import assign_shards, number_rows, shard_manifest
from residua.sources.npy import read_npy, write_npy  # noqa: F401


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def file_states(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Length and time of change of the file at a path, or of the files in a folder."""
    fs, p = _fs(spark, path)
    return {x.getPath().toString(): (x.getLen(), x.getModificationTime()) for x in fs.listStatus(p)}


def publish(spark: SparkSession, staged_path: str, path: str) -> None:
    """Put a finished folder in place of another by renaming; the older one goes only when the new one stands."""
    fs, source = _fs(spark, staged_path)
    _, target = _fs(spark, path)
    aside = None
    if fs.exists(target):
        _, aside = _fs(spark, f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex}")
        if not fs.rename(target, aside):
            raise OSError(f"{path} could not be moved aside")
    if not fs.rename(source, target):
        if aside is not None:
            fs.rename(aside, target)
        raise OSError(f"{staged_path} could not be renamed to {path}")
    if aside is not None:
        fs.delete(aside, True)


def write_atomic(df: DataFrame, path: str, kind: str = "parquet", **options: str) -> None:
    """Write beside the target, then publish: readers see the old table or the new one."""
    beside = f"{path.rstrip('/')}.uploading-{uuid.uuid4().hex}"
    df.write.options(**options).format(kind).save(beside)
    publish(df.sparkSession, beside, path)


def write_csv(df: DataFrame, path: str) -> None:
    """One headed file; for report tables."""
    write_atomic(df.coalesce(1), path, "csv", header="true", escape='"')


def write_bank(bank: DataFrame, path: str) -> None:
    """A feature bank sorted by hash. One commit holds keys and vectors, so they can't come apart."""
    write_atomic(bank.repartitionByRange("sequence_hash").sortWithinPartitions("sequence_hash"), path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small document, such as a manifest, to any file system."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_shards(rows: DataFrame, path: str, size: int = 2000, key: str = "sequence_hash") -> dict:
    """Shards in hash order as folders shard_id=n, in place of older ones, and manifest.json; returns the manifest.

    The manifest lists a shard in a row, so it grows with the number of shards, not of sequences.
    """
    sharded = assign_shards(rows, key, size)
    write_atomic_partitioned(sharded.drop("position"), f"{path}/shards")
    written = rows.sparkSession.read.parquet(f"{path}/shards")
    entries = [r.asDict() for r in shard_manifest(written, key).orderBy("shard_id").collect()]
    total = sum(e["row_count"] for e in entries)
    manifest = {"shard_size": size, "total_rows": total, "unique_sequence_hashes": written.select(key).distinct().count(), "columns": rows.columns, "shards": entries}
    manifest["duplicates"] = total - manifest["unique_sequence_hashes"]
    write_text(rows.sparkSession, json.dumps(manifest, indent=2, sort_keys=True), f"{path}/manifest.json")
    return manifest


def write_atomic_partitioned(sharded: DataFrame, path: str) -> None:
    beside = f"{path.rstrip('/')}.uploading-{uuid.uuid4().hex}"
    sharded.repartition("shard_id").sortWithinPartitions("shard_id", "sequence_hash").write.partitionBy("shard_id").parquet(beside)
    fs, target = _fs(sharded.sparkSession, path)
    fs.mkdirs(target.getParent())
    publish(sharded.sparkSession, beside, path)


def export_npy(bank: DataFrame, feature: str, path: str) -> None:
    """A feature as one .npy matrix and its hashes, sorted by hash, for tools that need it; tasks write their own rows."""
    rows = number_rows(bank.select("sequence_hash", F.col(feature).alias("vector")), "sequence_hash").withColumnRenamed("position", "row")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    write_npy(rows, path, n, width or 0)
