"""Which work is done: attempts as rows, the latest state by key, and what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C


def latest(attempts: DataFrame, key: str = "sequence_hash", order: str = "attempt") -> DataFrame:
    """The state of each key's last attempt; a success clears an earlier failure."""
    rest = [c for c in attempts.columns if c != key]
    state = F.max_by(F.struct(*rest), F.struct(F.col(order), (F.col("status") == "ok").cast("int")))
    return attempts.groupBy(key).agg(state.alias("r")).select(key, "r.*")


def completed(bank: DataFrame, features: list[str]) -> DataFrame:
    """Rows of a bank that count as done: status ok and every feature asked for finite.

    A bank that lacks a feature counts as empty.
    """
    if any(f not in bank.columns for f in features):
        return bank.limit(0)
    done = F.col("status") == "ok"
    for f in features:
        done = done & C.all_finite(F.col(f))
    return bank.filter(done)


def pending(work: DataFrame, done: DataFrame, key: str = "sequence_hash") -> DataFrame:
    """Rows of work whose key is not done."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def progress(attempts: DataFrame, key: str = "sequence_hash") -> DataFrame:
    """One row: completed and failed keys."""
    now = latest(attempts, key)
    return now.agg(F.count_if(F.col("status") == "ok").alias("completed"), F.count_if(F.col("status") != "ok").alias("failed"))
