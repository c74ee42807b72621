"""All queries of the engine's own operators, with their SQL."""

from __future__ import annotations

from residua.plans import chain, diagnostics, evidence, numeric, relational, sequences  # noqa: F401  (they register themselves)
from residua.plans.registry import ENTRIES, Query

FLAGSHIP = "seq_dedup"


def queries() -> dict[str, Query]:
    return {name: e.run for name, e in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: e.sql for name, e in ENTRIES.items() if e.sql}
