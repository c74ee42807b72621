"""Declared expectations and what of them holds; each is one aggregation."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C


@dataclass(frozen=True)
class Expectations:
    """Checks of a table: columns it needs, keys that are unique and not empty, its row count, conditions of rows."""

    columns: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    filled: tuple[str, ...] = ()
    rows: int | None = None
    every_row: dict[str, str] = field(default_factory=dict)

    def evaluate(self, df: DataFrame) -> DataFrame:
        """A row a check: check, failures, ok."""
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            return df.sparkSession.createDataFrame([(f"column {c}", 1, False) for c in missing], "check string, failures long, ok boolean")
        sums: dict[str, Column] = {}
        for c in self.unique:
            sums[f"unique {c}"] = F.count(F.lit(1)) - F.count_distinct(c)
        for c in self.filled:
            sums[f"filled {c}"] = F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "")
        for name, condition in self.every_row.items():
            sums[name] = F.count_if(~F.coalesce(F.expr(condition), F.lit(False)))
        if self.rows is not None:
            sums["row count"] = F.abs(F.count(F.lit(1)) - F.lit(self.rows))
        if not sums:
            return df.sparkSession.createDataFrame([], "check string, failures long, ok boolean")
        one = df.agg(*[v.cast("long").alias(f"c{k}") for k, v in enumerate(sums.values())])
        listed = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{k}").alias("failures")) for k, n in enumerate(sums)])).alias("x")
        return one.select(listed).select("x.*", (F.col("x.failures") == 0).alias("ok"))


def enforce(results: DataFrame) -> None:
    """Raise if a check failed, naming the first ones."""
    bad = results.filter("not ok").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r.check}: {r.failures}" for r in bad))


def hash_conflicts(rows: DataFrame, hash_: str, text: str) -> DataFrame:
    """Hashes with more than one text."""
    return rows.groupBy(hash_).agg(F.count_distinct(text).alias("texts")).filter(F.col("texts") > 1)


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of left that right lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def bank_checks(bank: DataFrame, features: dict[str, int], rows: int | None = None) -> DataFrame:
    """Checks of a feature bank: unique keys, statuses, and the size and finiteness of the declared features."""
    needed = ("sequence_hash", "length", "chunk_count", "status", *features)
    if any(c not in bank.columns for c in needed):
        return Expectations(columns=needed).evaluate(bank)
    conditions = {"status ok": "status = 'ok'", "positive length": "length > 0"}
    marked = bank
    for name, dim in features.items():
        marked = marked.withColumn(f"_{name}_finite", C.all_finite(F.col(name)))
        conditions |= {f"{name} size": f"size({name}) = {dim}", f"{name} finite": f"_{name}_finite"}
    return Expectations(unique=("sequence_hash",), filled=("sequence_hash",), rows=rows, every_row=conditions).evaluate(marked)


def shard_matches(shard: DataFrame, entry: dict, key: str = "sequence_hash", text: str = "amino_acid_sequence") -> DataFrame:
    """Checks of a shard against its manifest entry: count, uniqueness, first and last hash, and texts."""
    r = shard.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d"), F.min(key).alias("first"), F.max(key).alias("last"), F.count_if(F.coalesce(text, F.lit("")) == "").alias("empty")
    )
    tests = {
        "row count": F.col("n") == entry["row_count"],
        "unique": F.col("n") == F.col("d"),
        "first hash": F.col("first").eqNullSafe(F.lit(entry["first_sequence_hash"])),
        "last hash": F.col("last").eqNullSafe(F.lit(entry["last_sequence_hash"])),
        "texts": F.col("empty") == 0,
    }
    return r.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), (~t).cast("long").alias("failures"), t.alias("ok")) for n, t in tests.items()])).alias("x")).select("x.*")


def to_json(document: dict) -> str:
    """A quality document as it is written: sorted keys, two blanks."""
    return json.dumps(document, indent=2, sort_keys=True)
