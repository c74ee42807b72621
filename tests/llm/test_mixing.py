from collections import defaultdict

import random
from fractions import Fraction

import corpus_pipeline
import duckdb
import pandas as pd
import pytest

from residua.llm import mixing, queries
from residua.session import table

NAMES = "doc_id, source, block, start, slot"


def brute(rows, block_chars, weights=None):
    con = duckdb.connect()
    frame = {"doc_id": pd.array([r[0] for r in rows], "Int64"), "text": pd.array([r[1] for r in rows], "string")}
    con.register("documents", pd.DataFrame(frame | {"source": pd.array([r[2] for r in rows], "string")}))
    return sorted(con.sql(f"SELECT {NAMES} FROM ({mixing.oracle_sql(block_chars, weights)})").fetchall(), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block_chars", [1 << 16, 3000])
def test_whole_table(spark, sf_dir, block_chars):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got(mixing.mix(docs, block_chars=block_chars)) == brute(rows, block_chars)


def test_less_than_a_block_off(spark):
    rows = [(i, "x" * 99, f"s{min(i % 7, 3)}") for i in range(700)]
    weights = {"s0": 0.5, "s1": 0.25, "s2": 0.15, "s3": 0.1}
    placed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights, 100).collect()
    slots = {r.slot: r.source for r in placed}
    assert sorted(slots) == list(range(700))
    given = defaultdict(int)
    for t in range(700):
        given[slots[t]] += 1
        if max(given.values()) >= 100:  # the first source has run out
            break
        assert all(abs(given[s] - w * (t + 1)) < 1 for s, w in weights.items())


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "abc" * 50, None), (3, "x" * 5000, "long"), (3, "x" * 5000, "long"), (4, "y", "b")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, slot int, mass int")
    assert got(mixing.mix(docs, block_chars=100)) == brute(rows, 100)
    assert got(mixing.in_order(docs, block_chars=100)) == sorted(((*r, 1, 2) for r in rows), key=str)
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"b": 0.0})
    many = spark.range(300).selectExpr("id AS doc_id", "'t' AS text", "string(id) AS source")
    with pytest.raises(ValueError):
        mixing.mix(many)


def test_any_number_of_sources(spark, tmp_path):
    rows = [(k, "x" * (k * 37 % 900), f"s{k % 331}" if k % 331 else None) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert got(mixing.mix(docs, block_chars=400, max_sources=None)) == brute(rows, 400)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op2_source_mixing(spark, str(tmp_path)).count() == len(rows)
    assert corpus_pipeline.source_mixing(spark, docs, str(tmp_path)).count() == len(rows)


def test_phases_are_those_of_the_plan(spark):
    sources = [(None, 7, 30), ("a", 900, 500), ("b", 1, 1), ("é", 450, 269), ("z", 2000, 200)]
    frame = spark.createDataFrame(sources, "source string, blocks long, share int")
    planned = {(r.source, r.first, r["last"], r.at, r.share, r.period): r.places for r in mixing._plan(frame).collect()}
    found = {x[:6]: x[6] for x in mixing._phases(sources)}
    assert set(found) == set(planned)
    assert all(found[k] == planned[k][: len(found[k])] for k in found)


def off_by_less_than_a_block(plan, weights, blocks, slots):
    """Of a schedule (rows of _PHASES) whether all sources stay within a block while none has run out."""
    total, order = sum(weights.values()), {}
    for source, first, last, at, share, period, places in plan:
        for k in range(first, last):
            order[at + (k - first) // share * period + places[(k - first) % share]] = source
    given = dict.fromkeys(weights, 0)
    for t in range(slots):
        given[order[t]] += 1
        if any(given[s] >= blocks[s] for s in weights):
            return t
        if t % 97 == 0 or t > slots - 100:
            assert all(abs(given[s] - Fraction(w) * (t + 1) / total) < 1 for s, w in weights.items()), t
    return slots


def test_random_weights_over_many_slots():
    """Whole shares of any size keep within a block for ever, not for a period."""
    rng = random.Random(5)
    for n in (2, 5, 12):
        weights = {f"s{k}": Fraction(repr(rng.random() ** 3 + 1e-4)) for k in range(n)}
        shares = mixing.whole_shares(weights, list(weights))
        assert {s: Fraction(x, sum(shares.values())) for s, x in shares.items()} == {s: w / sum(weights.values()) for s, w in weights.items()}
        blocks = {s: int(100_000 * w / sum(weights.values())) + 50 for s, w in weights.items()}
        plan = mixing._phases([(s, blocks[s], shares[s]) for s in weights])
        assert off_by_less_than_a_block(plan, weights, blocks, 100_000) > 99_000


def test_a_weight_under_a_thousandth():
    weights = {"a": 0.9995, "b": 0.0005}
    assert mixing.whole_shares(weights, ["a", "b"]) == {"a": 1999, "b": 1}
    plan = mixing._phases([("a", 50_000, 1999), ("b", 50, 1)])
    exact = {s: Fraction(repr(w)) for s, w in weights.items()}
    assert off_by_less_than_a_block(plan, exact, {"a": 50_000, "b": 50}, 20_000) == 20_000
    assert mixing.whole_shares({"a": 1, None: 3}, ["a", None, "other"]) == {"a": 250, None: 750, "other": 1}
    with pytest.raises(ValueError):
        mixing.whole_shares({"a": -1.0}, ["a"])


@pytest.mark.parametrize("weights", [{"a": 3.0, "b": 1.0}, {"a": 0.61803398875, "b": 0.1415926535}, {"c": 0.0001, "a": 0.9999}])
def test_weights_in_rows(spark, weights, monkeypatch):
    rows = [(k, "x" * (k * 37 % 900), [None, "a", "b", "c"][k % 4]) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert got(mixing.mix(docs, weights, 400)) == brute(rows, 400, weights)
    monkeypatch.setattr(mixing, "MAX_SLOTS", 200)
    placed = mixing.mix(docs, weights, 400).collect()
    assert len(placed) == 300 and (len({r.slot for r in placed}) <= 204 or sum(mixing.whole_shares(weights, [None, "a", "b", "c"]).values()) <= 200)
