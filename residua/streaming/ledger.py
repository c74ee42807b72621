"""The ledger of attempts as a stream: state by key, in place of reading all that was written before.

1. Attempts that come again, in the same file or a later one, are dropped by their number.
2. What is left of a micro-batch is summed up in parts of each key, so that a key with very many attempts is
   spread over tasks, and passes on PARTS rows a batch at most.
3. A key's state takes these in: its last attempt in order, whatever the order of arrival, and its counts. A
   later success clears an earlier failure. Each key touched in a batch gives one row, numbered by version.
4. A key whose last attempt failed may have a timer. When it runs out before a success comes, the key gives
   a row of kind `retry`.

A batch costs what its rows and keys cost; state is kept by Spark's RocksDB store under the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Parts of a key within a micro-batch.
PARTS = 16
CHANGES = "key string, version long, kind string, status string, at long, attempt long, attempts long, failures long"
_SUMS = "key string, part int, at long, attempt long, ok boolean, attempts long, failures long"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_or_folder(path: str) -> str:
    """A pattern that fits exactly this path: a file stream over one takes a single file as well as a folder."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that the ledger needs, for queries started within; the setting is put back afterwards."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def _summed(rows) -> tuple:
    """The last attempt of rows by (at, attempt), and the sums of their counts."""
    last, attempts, failures = None, 0, 0
    for r in rows:
        attempts, failures = attempts + r.attempts, failures + r.failures
        if last is None or (r.at, r.attempt) > last[:2]:
            last = (r.at, r.attempt, r.ok)
    return (*last, attempts, failures)


class _Parts(StatefulProcessor):
    """Sums up the rows of a part in one batch; it keeps no state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, attempt, ok, attempts, failures = _summed(rows)
        yield Row(key=key[0], part=key[1], at=at, attempt=attempt, ok=ok, attempts=attempts, failures=failures)

    def close(self) -> None:
        pass


class _Ledger(StatefulProcessor):
    def __init__(self, retry_ms: int | None, most_attempts: int | None):
        self.retry_ms, self.most_attempts = retry_ms, most_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "version long, at long, attempt long, ok boolean, attempts long, failures long")

    def _row(self, key, kind: str) -> Row:
        version, at, attempt, ok, attempts, failures = self.state.get()
        status = "ok" if ok else "failed"
        return Row(key=key[0], version=version, kind=kind, status=status, at=at, attempt=attempt, attempts=attempts, failures=failures)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, attempt, ok, attempts, failures = _summed(rows)
        version = 0
        if self.state.exists():
            version, at0, attempt0, ok0, attempts0, failures0 = self.state.get()
            if (at0, attempt0) > (at, attempt):
                at, attempt, ok = at0, attempt0, ok0
            attempts, failures = attempts + attempts0, failures + failures0
        self.state.update((version + 1, at, attempt, ok, attempts, failures))
        if self.retry_ms is not None:
            for timer in [*self.handle.listTimers()]:
                self.handle.deleteTimer(timer)
            if not ok and (self.most_attempts is None or attempts < self.most_attempts):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_ms)
        yield self._row(key, "state")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        version, *rest = self.state.get()
        self.state.update((version + 1, *rest))
        yield self._row(key, "retry")

    def close(self) -> None:
        pass


def ledger_changes(attempts: DataFrame, retry_ms: int | None = None, most_attempts: int | None = None) -> DataFrame:
    """The stream of changes (CHANGES) that a stream of attempts (key, attempt, at, ok) makes.

    attempt tells the attempts of a key apart; those with the same number are one, of which any counts. at
    and then attempt order them. Rows without a key, a number or a time are left out; a null ok is a failure.
    With retry_ms, a failed key gives a row of kind `retry` that long after it came, unless it has had
    most_attempts; timers are for queries that run on, as one with the trigger availableNow would never end.
    Start the query within state_store().
    """
    rows = attempts.select(F.col("key").cast("string").alias("key"), F.col("attempt").cast("long").alias("attempt"), F.col("at").cast("long").alias("at"), F.coalesce("ok", F.lit(False)).alias("ok"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("attempt").isNotNull() & F.col("at").isNotNull())
    once = rows.dropDuplicates(["key", "attempt"])
    part = F.pmod(F.xxhash64("attempt"), F.lit(PARTS)).cast("int")
    once = once.select("key", part.alias("part"), "at", "attempt", "ok", F.lit(1).cast("long").alias("attempts"), (~F.col("ok")).cast("long").alias("failures"))
    sums = once.groupBy("key", "part").transformWithState(_Parts(), _SUMS, "Append", "None")
    mode = "None" if retry_ms is None else "ProcessingTime"
    return sums.groupBy("key").transformWithState(_Ledger(retry_ms, most_attempts), CHANGES, "Append", mode)


def current(changes: DataFrame) -> DataFrame:
    """The last state of each key among changes that were written: key, status, at, attempt, attempts, failures."""
    state = F.struct("status", "at", "attempt", "attempts", "failures")
    return changes.groupBy("key").agg(F.max_by(state, "version").alias("s")).select("key", "s.*")


def due(changes: DataFrame) -> DataFrame:
    """Keys whose retry is due: nothing has come since their timer ran out."""
    return changes.groupBy("key").agg(F.max_by(F.struct("kind", "attempts"), "version").alias("s")).filter("s.kind = 'retry'").select("key", "s.attempts")
