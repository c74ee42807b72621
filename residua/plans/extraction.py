"""Feature extraction over shards: what is pending is extracted, checked and published; the rest is left alone."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.operators import checks, encoder, ledger
from residua.sources import annotation, sinks

FEATURES = ("mean", "std", "parti")


def extract(
    spark: SparkSession, work: DataFrame, out: str, make: Callable[[], encoder.Encoder], max_tokens: int, max_batch_size: int, features: Sequence[str] = FEATURES
) -> dict:
    """Bring the bank at `out` up to date with work (sequence_hash, amino_acid_sequence); returns its counts.

    Rows already done stay; failed ones are tried again and replace their earlier failure. The bank holds
    the features asked for and no others; a bank that lacks one of them is made anew.
    """
    columns = ["sequence_hash", "length", "chunk_count", "status", "error", *features]
    work = work.select("sequence_hash", "amino_acid_sequence").dropDuplicates(["sequence_hash"])
    try:
        bank = spark.read.parquet(out)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        bank = None
    if bank is not None and set(columns) <= set(bank.columns):
        done = ledger.completed(bank, list(features)).join(work.select("sequence_hash"), "sequence_hash", "left_semi")
        todo = ledger.pending(work, done)
        result = done.select(*columns).unionByName(encoder.extract_features(todo, make, max_tokens, max_batch_size).select(*columns))
    else:
        result = encoder.extract_features(work, make, max_tokens, max_batch_size)
    sinks.write_bank(result.select(*columns), out)
    now = spark.read.parquet(out).agg(F.count_if(F.col("status") == "ok").alias("completed"), F.count_if(F.col("status") != "ok").alias("failed"))
    return now.first().asDict()


def run_shards(
    spark: SparkSession, root: str, out: str, make: Callable[[], encoder.Encoder] = encoder.HashEncoder, max_tokens: int = 8192, max_batch_size: int = 16, limit: int | None = None
) -> list[dict]:
    """Extract every shard of the manifest under root that has no valid bank yet; a report a shard.

    A shard that fails its checks is reported and doesn't stop the others.
    """
    shards = annotation.read_manifest(spark, f"{root}/manifest.json").select(F.explode("shards").alias("s")).select("s.*")
    by_id = {int(s.shard_id): s.asDict() for s in shards.collect()}  # a row a shard
    reports = []
    for number, entry in sorted(by_id.items())[:limit]:
        target = f"{out}/shard_{number:04d}"
        shard = spark.read.parquet(f"{root}/shards/shard_id={number}")
        bad = checks.shard_matches(shard, entry).filter("not ok").collect()
        if bad:
            reports.append({"shard_id": number, "state": "input_invalid", "checks": [r.check for r in bad]})
            continue
        dims = {f: make().dim for f in FEATURES}
        try:
            valid = checks.bank_checks(spark.read.parquet(target), dims, entry["row_count"]).filter("not ok").isEmpty()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            valid = False
        if valid:
            reports.append({"shard_id": number, "state": "already_valid"})
            continue
        counts = extract(spark, shard, target, make, max_tokens, max_batch_size)
        bad = checks.bank_checks(spark.read.parquet(target), dims, entry["row_count"]).filter("not ok").collect()
        reports.append({"shard_id": number, "state": "invalid" if bad else "done", "checks": [r.check for r in bad], **counts})
    sinks.write_text(spark, json.dumps(reports, indent=2, sort_keys=True), f"{out}/run.json")
    return reports
