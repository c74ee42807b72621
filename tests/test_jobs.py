"""The jobs over growing input, run again, and from the command line."""

import json

import pytest
from pyspark.sql import functions as F

from jobs import attempt_ledger, production_shards
from residua.operators import ledger

CONFIG = {"id": "id", "text": "body", "source": "site", "shard_rows": 3, "window": 10, "overlap": 4}
RECORDS = "id long, body string, site string, record_id string, sequence string"


def rows_of(spark, path):
    return sorted(map(tuple, production_shards.read(spark, path).collect()), key=str)


def test_shards_of_odd_records_and_again(spark, tmp_path):
    texts = ["a" * 25, "b", None, "", "b", "é" * 10, "c" * 11, "d"]
    data = [(k, t, s, "x", "y") for k, (t, s) in enumerate(zip(texts, ["p", "q", "q", None, "", "p", "p", "q"], strict=True))]
    data.append((None, "b", "p", None, None))
    spark.createDataFrame(data, RECORDS).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    counts = production_shards.run(spark, str(tmp_path / "in"), out, CONFIG)
    assert counts == {"records": 9, "empty": 2, "sequences": 5, "shards": 2}
    first = rows_of(spark, out)
    b = [r for r in production_shards.read(spark, out).collect() if r.records == 3]
    assert {(r.record_id, r.first_record_id, r.windows, r.source) for r in b} == {(1, 1, 1, "q"), (4, 1, 1, "unknown"), (None, 1, 1, "p")}
    assert {r.length: r.windows for r in production_shards.read(spark, out).collect() if r.length} == {25: 4, 1: 1, 10: 1, 11: 2}
    assert production_shards.run(spark, str(tmp_path / "in"), out, CONFIG) == counts and rows_of(spark, out) == first


def test_some_sources_are_made_anew(spark, tmp_path):
    out = str(tmp_path / "out")

    def at(name, data):
        path = str(tmp_path / name)
        spark.createDataFrame([(*r, None, None) for r in data], RECORDS).write.parquet(path)
        return path

    old, new = [(1, "a", "p"), (2, "b", "q")], [(1, "A", "p"), (3, "c", "q")]
    production_shards.run(spark, at("old", old), out, CONFIG)
    production_shards.run(spark, at("new", new), out, CONFIG, sources=["q"])  # p stays as it was
    both = [(1, "a", "p"), (3, "c", "q")]
    again = str(tmp_path / "again")
    production_shards.run(spark, at("both", both), again, CONFIG)
    assert rows_of(spark, out) == rows_of(spark, again)


def test_no_records(spark, tmp_path):
    spark.createDataFrame([], RECORDS).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    assert production_shards.run(spark, str(tmp_path / "in"), out, CONFIG) == {"records": 0, "empty": 0, "sequences": 0, "shards": 0}


def test_texts_are_shuffled_once(spark, tmp_path):
    spark.range(400).selectExpr("id % 300 AS record_id", "'p' AS source", "repeat(sha2(string(id % 300), 256), 40) AS sequence").selectExpr(
        "source", "record_id", "sha2(sequence, 256) AS sequence_hash", "length(sequence) AS length", "'' AS issue", "sequence"
    ).write.parquet(str(tmp_path / "in"))
    records = spark.read.parquet(str(tmp_path / "in"))
    made = production_shards._sequences(records, CONFIG)
    plan = made._jdf.queryExecution().sparkPlan().toString()
    assert "max(sequence#" not in plan and "Window" in plan  # the shards are numbered, of hashes alone
    assert made.agg(F.count("*"), F.sum("records"), F.count_distinct("shard_id")).first()[:] == (300, 400, 100)
    clash = records.withColumn("sequence", F.when(F.rand(1) < 0.5, F.col("sequence")).otherwise(F.lit("other")))
    with pytest.raises(Exception, match="two texts under hash"):
        production_shards._sequences(clash, CONFIG).collect()


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, at long, user_id long, event_type string").select("event_id", F.timestamp_micros("at").alias("ts"), "user_id", "event_type")


JOB = {"failed_types": ["error"], "buckets": 3}


def expected(spark, rows):
    """The batch ledger of the same rows, each attempt once."""
    df = spark.createDataFrame([r for r in set(rows) if r[2] is not None and r[1] is not None], "attempt long, at long, key long, kind string")
    df = df.withColumn("status", F.when(F.coalesce(F.col("kind") != "error", F.lit(False)), "ok").otherwise("failed")).withColumn("order", F.struct("at", "attempt"))
    last = {r.key: r for r in ledger.latest(df, "key", "order").collect()}
    sums = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "failed").alias("f")).collect()
    return sorted((r.key, last[r.key].status, last[r.key].attempt, last[r.key].at, r.n, r.f) for r in sums)


def test_the_ledger_over_growing_input(spark, tmp_path):
    """Files out of order and with rows that came before; each run takes only what is new."""
    later = [(10 + k, 5000 + k, k % 7, ["click", "error", None][k % 3]) for k in range(40)]
    earlier = [(100 + k, k, k % 9, "error" if k % 4 else "view") for k in range(40)] + [(900, None, 1, "view"), (901, 3, None, "view")]
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    seen = []
    for part in (later, earlier + later[:20], []):
        if part:
            events(spark, part).coalesce(1).write.mode("append").parquet(folder)
        read = attempt_ledger.run(spark, folder, out, state, JOB)["rows_read"]
        seen += part
        assert read == len(part)
        assert sorted(map(tuple, attempt_ledger.read(spark, out).collect())) == expected(spark, seen)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    # An item changes only in batches that touch it.
    assert spark.read.parquet(out).groupBy("key").count().agg(F.max("count")).first()[0] <= 2


@pytest.mark.parametrize("job", [attempt_ledger, production_shards])
def test_command_line(job):
    with open(job.CONFIG) as f:
        assert json.load(f)
    a = job.parser().parse_args(["--input", "i", "--output", "o", *(["--checkpoint", "c"] if job is attempt_ledger else [])])
    assert (a.input, a.output, a.config) == ("i", "o", job.CONFIG)
