"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with DuckDB SQL for the same rows where there is any."""

    def add(f: Query) -> Query:
        if f.__name__ in ENTRIES:
            raise ValueError(f"two queries are named {f.__name__}")
        ENTRIES[f.__name__] = Entry(f, sql)
        return f

    return add
