"""Command line: python -m residua.cli COMMAND."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from residua.operators import batching, encoder, graph, metrics
from residua.plans import annotation, extraction
from residua.session import build_session
from residua.sources import sinks


def _map(spark: SparkSession, a: argparse.Namespace) -> object:
    names = "vocabulary targets gtf fasta mane complete withdrawn source release".split()
    tables = annotation.run(spark, annotation.Inputs(**{n: getattr(a, n) for n in names}), a.out)
    return sorted(tables)


def _shard(spark: SparkSession, a: argparse.Namespace) -> object:
    manifest = sinks.write_shards(spark.read.parquet(a.input), a.output_dir, a.shard_size)
    return {k: v for k, v in manifest.items() if k != "shards"}


def _extract(spark: SparkSession, a: argparse.Namespace) -> object:
    size = 1 if a.disable_batching else a.max_batch_size
    return extraction.extract(spark, spark.read.parquet(a.input), a.output, encoder.HashEncoder, a.max_tokens, size, a.features)


def _run(spark: SparkSession, a: argparse.Namespace) -> object:
    return extraction.run_shards(spark, a.input_root, a.output_root, encoder.HashEncoder, a.max_tokens, a.max_batch_size, a.limit)


def _benchmark(spark: SparkSession, a: argparse.Namespace) -> object:
    """Serial against batched extraction of a stratified sample: agreement, seconds and rates."""
    rows = spark.read.parquet(a.input).withColumn("n", F.length("amino_acid_sequence"))
    bins = [(100, 350), (450, 550), (650, 750), (850, 950), (980, 1022)]
    sample = batching.stratified_sample(rows, "n", "sequence_hash", bins, a.count).cache()
    n, residues = sample.agg(F.count(F.lit(1)), F.sum("n")).first()

    def timed(size: int, tokens: int):
        began = time.perf_counter()
        bank = encoder.extract_features(sample, encoder.HashEncoder, tokens, size).cache()
        bank.count()
        return bank, time.perf_counter() - began

    serial, seconds = timed(1, 8192)
    def rates(took: float) -> dict:
        return {"seconds": took, "per_hour": n / took * 3600, "residues_per_second": (residues or 0) / took}

    out = [{"mode": "serial", **rates(seconds)}]
    for tokens in a.max_tokens:
        batched, took = timed(a.max_batch_size, tokens)
        agreement = metrics.vector_agreement(serial, batched, "sequence_hash", "mean")
        worst = agreement.agg(F.min("cosine").alias("least_cosine"), F.max("max_abs_error").alias("max_abs_error")).first().asDict()
        out.append({"mode": f"batched {tokens}", **rates(took), "speedup": seconds / took, **worst})
    return out


def _compare(spark: SparkSession, a: argparse.Namespace) -> object:
    """The dense kernel against the one on edges, on the sequences' reduced weights."""
    rows = spark.read.parquet(a.input).orderBy("sequence_hash").limit(a.count).collect()  # the feature: a few of them
    out = []
    for r in rows:
        matrix = encoder.HashEncoder().encode([r.amino_acid_sequence[: encoder.NATIVE_LIMIT]])[0][1]
        n = len(matrix)
        dense, rounds, settled = graph.pagerank(matrix)
        edges = spark.createDataFrame([(i, j, float(matrix[i, j])) for i in range(n) for j in range(n)], "i long, j long, w double")
        sparse = {x.node: x.score for x in graph.edge_pagerank(edges).collect()}
        out.append({"sequence_hash": r.sequence_hash, "rounds": rounds, "converged": settled, "max_abs_error": max(abs(dense[k] - sparse[k]) for k in range(n))})
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="residua")
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, **options: dict) -> None:
        c = commands.add_parser(name, help=run.__doc__)
        c.set_defaults(run=run)
        for option, how in options.items():
            c.add_argument("--" + option.replace("_", "-"), **how)

    need = {"required": True}
    batches = {"max_tokens": {"type": int, "default": 8192}, "max_batch_size": {"type": int, "default": 16}}
    paths = {n: need for n in "vocabulary targets gtf fasta mane complete withdrawn out".split()}
    command("map", _map, **paths, source={"default": ""}, release={"default": ""})
    command("shard", _shard, input=need, output_dir=need, shard_size={"type": int, "default": 2000})
    features = {"nargs": "+", "choices": extraction.FEATURES, "default": list(extraction.FEATURES)}
    command("extract", _extract, input=need, output=need, features=features, disable_batching={"action": "store_true"}, **batches)
    command("run-shards", _run, input_root=need, output_root=need, limit={"type": int}, **batches)
    command(
        "benchmark", _benchmark, input=need, count={"type": int, "default": 200}, max_batch_size=batches["max_batch_size"],
        max_tokens={"type": int, "action": "append", "default": None},
    )
    command("compare-pagerank", _compare, input=need, count={"type": int, "default": 25})
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    a = parser().parse_args(argv)
    if a.command == "benchmark" and not a.max_tokens:
        a.max_tokens = [4096, 8192, 16384]
    result = a.run(spark or build_session(), a)
    print(json.dumps(result, indent=2, default=str))
    return result


if __name__ == "__main__":
    main()
