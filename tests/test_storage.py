import json

import numpy as np
from pyspark.sql import functions as F

from residua.operators import encoder, ledger
from residua.sources import annotation, sinks
from residua.streaming.ingest import ingest_available


def bank_of(spark, n):
    rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("sequence_hash"), F.repeat(F.lit("MK"), (F.col("id") + 1).cast("int")).alias("amino_acid_sequence"))
    return rows, encoder.extract_features(rows)


def test_bank_and_shards(spark, tmp_path):
    rows, bank = bank_of(spark, 25)
    path = str(tmp_path / "bank")
    sinks.write_bank(bank.limit(3), path)
    sinks.write_bank(bank, path)  # in place of the first
    assert spark.read.parquet(path).count() == 25 and [p.name for p in tmp_path.iterdir()] == ["bank"]
    manifest = sinks.write_shards(rows, str(tmp_path / "out"), size=10)
    manifest = sinks.write_shards(rows, str(tmp_path / "out"), size=10)
    assert [s["row_count"] for s in manifest["shards"]] == [10, 10, 5] and manifest["duplicates"] == 0
    assert json.loads((tmp_path / "out" / "manifest.json").read_text()) == manifest
    read = annotation.read_manifest(spark, str(tmp_path / "out" / "manifest.json")).select(F.explode("shards").alias("s")).select("s.*")
    assert sorted(r.row_count for r in read.collect()) == [5, 10, 10]
    sinks.write_csv(rows, str(tmp_path / "csv"))
    back = annotation.read_delimited(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_npy_round_trip(spark, tmp_path):
    _, bank = bank_of(spark, 7)
    sinks.export_npy(bank, "mean", str(tmp_path / "mean"))
    assert np.load(tmp_path / "mean.npy").shape == (7, 16)
    back = {r.sequence_hash: r.vector for r in sinks.read_npy(spark, str(tmp_path / "mean")).collect()}
    assert back == {r.sequence_hash: r["mean"] for r in bank.collect()}


def test_incremental_ingest(spark, tmp_path):
    rows, _ = bank_of(spark, 12)
    folder, bank, checkpoint = (str(tmp_path / x) for x in ("in", "bank", "state"))
    listed = sorted(rows.collect())
    seen = []

    def process(batch):
        seen.append(batch.count())
        return encoder.extract_features(batch)

    for part in (listed[:5] + listed[:2], listed[3:12]):
        spark.createDataFrame(part, rows.schema).write.mode("append").parquet(folder)
        ingest_available(spark, folder, rows.schema, bank, checkpoint, process)
    ingest_available(spark, folder, rows.schema, bank, checkpoint, process)
    out = spark.read.parquet(bank)
    assert seen == [5, 7] and out.count() == out.select("sequence_hash").distinct().count() == 12


def test_failed_rows_are_tried_again(spark, tmp_path):
    folder, bank, checkpoint = (str(tmp_path / x) for x in ("in", "bank", "state"))
    tried = []

    def process(batch):
        tried.append(sorted(r.sequence_hash for r in batch.collect()))
        state = "ok" if len(tried) > 1 else "failed"
        return batch.withColumn("status", F.when(F.col("sequence_hash") == "b", state).otherwise("ok"))

    for part in (["a", "b"], ["a", "b", "c"], ["b", "c"]):
        rows = spark.createDataFrame([(h,) for h in part], "sequence_hash string")
        rows.write.mode("append").parquet(folder)
        ingest_available(spark, folder, rows.schema, bank, checkpoint, process)
    assert tried == [["a", "b"], ["b", "c"], []]
    now = ledger.latest(spark.read.parquet(bank), "sequence_hash", "batch").collect()
    assert sorted((r.sequence_hash, r.status) for r in now) == [("a", "ok"), ("b", "ok"), ("c", "ok")]
