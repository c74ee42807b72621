"""The jobs as registered queries: each runs twice into one new folder and returns the output as it then stands."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobs import attempt_ledger, production_shards
from residua.session import shared_dir

#: Rows of a shard in the query: small, so that small tables have several.
SHARD_ROWS = 200


def _config(job, **changes) -> dict:
    with open(job.CONFIG) as f:
        return json.load(f) | changes


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def job1_production_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, config = _folder(spark, "job1"), _config(production_shards, shard_rows=SHARD_ROWS)
    for _ in range(2):
        production_shards.run(spark, f"{str(sf_dir).rstrip('/')}/documents.parquet", out, config)
    return production_shards.read(spark, out)


def job2_attempt_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "job2")
    for _ in range(2):
        attempt_ledger.run(spark, f"{str(sf_dir).rstrip('/')}/events.parquet", f"{out}/ledger", f"{out}/checkpoint", _config(attempt_ledger))
    return attempt_ledger.read(spark, f"{out}/ledger")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"job1_production_shards": job1_production_shards, "job2_attempt_ledger": job2_attempt_ledger}


def oracle_sql() -> dict[str, str]:
    c = _config(production_shards)
    step = c["window"] - c["overlap"]
    bins = "CASE " + " ".join(f"WHEN length <= {high} THEN {k}" for k, high in enumerate((512, 1022, 1500, 2000, 3000, 5000))) + " ELSE 6 END"
    return {
        "job1_production_shards": f"""
WITH records AS (
    SELECT coalesce(nullif(source, ''), '{production_shards.NO_SOURCE}') AS source, doc_id AS record_id, nullif(text, '') AS t FROM documents
), sequences AS (
    SELECT sha256(t) AS sequence_hash, length(t)::INTEGER AS length, min(record_id) AS first_record_id, count(*) AS records FROM records WHERE t IS NOT NULL GROUP BY t
), numbered AS (
    SELECT *, ((row_number() OVER (ORDER BY sequence_hash) - 1) // {SHARD_ROWS})::INTEGER AS shard_id, {bins} AS length_bin,
        CASE WHEN length <= {c["window"]} THEN 1 ELSE (length - {c["window"]} + {step - 1}) // {step} + 1 END AS windows FROM sequences
), shards AS (
    SELECT shard_id, count(*) AS shard_rows, min(sequence_hash) AS shard_first, sha256(string_agg(sequence_hash, chr(10) ORDER BY sequence_hash)) AS shard_sha256 FROM numbered GROUP BY 1
)
SELECT source, record_id, CASE WHEN t IS NULL THEN 'empty_sequence' ELSE '' END AS issue, sequence_hash, length, length_bin, windows, records,
    first_record_id, shard_id, shard_rows, shard_first, shard_sha256
FROM records LEFT JOIN numbered ON sequence_hash = sha256(t) LEFT JOIN shards USING (shard_id)""",
        "job2_attempt_ledger": """
WITH attempts AS (
    SELECT user_id, event_id, any_value(epoch_us(ts)) AS micros, any_value(coalesce(event_type <> 'error', false)) AS ok
    FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL
)
SELECT user_id, CASE WHEN arg_max(ok, (micros, event_id)) THEN 'ok' ELSE 'failed' END AS status, arg_max(event_id, (micros, event_id)) AS last_event_id,
    max(micros) AS last_micros, count(*) AS attempts, count(*) FILTER (WHERE NOT ok) AS failures
FROM attempts GROUP BY user_id""",
    }
