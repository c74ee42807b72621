import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from residua.llm import queries
from residua.llm.packing import encode, pack_documents, pack_items
from residua.session import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def held(tokens, prompt, limits):
    item, start, length, bin_, offset = pack_items(np.array(tokens), np.array(prompt), limits)
    cap, segments, loss = limits
    assert (length > 0).all()
    for i, n in enumerate(tokens):
        mine = sorted(zip(start[item == i], length[item == i], strict=True))
        at = 0
        for s, k in mine:
            assert s == at
            at += k
        assert at == n
    for b in set(bin_.tolist()):
        mine = sorted(zip(offset[bin_ == b], length[bin_ == b], strict=True))
        at = 0
        for o, k in mine:
            assert o == at
            at += k
        assert at == cap or at & (at - 1) == 0
        assert len(mine) <= segments
        bearing = sum(
            max(0, s + k - max(s, prompt[i]))
            for i, s, k, x in zip(item, start, length, bin_, strict=True)
            if x == b
        )
        assert bearing <= loss


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90)), max_size=25), st.integers(1, 5), st.integers(1, 32))
def test_limits_and_coverage(items, segments, loss):
    tokens = [a for a, _ in items]
    held(tokens, [min(a, b) for a, b in items], (32, segments, loss))


def test_bad_limits():
    with pytest.raises(ValueError):
        pack_items(np.array([1]), np.array([0]), (0, 1, 1))


def test_special_strings_and_null():
    t = Tokenizer.from_file(PATH)
    for text in ["", "a<|endoftext|>b", "Ünï  \n\n x"]:
        assert encode([text], PATH)[0].tolist() == [*t.encode(text, add_special_tokens=False).ids, 1]
    assert encode([None], PATH)[0].tolist() == [1]


def test_documents(spark):
    rows = [(1, "word " * 9000, "x"), (2, None, "y"), (2, None, "y"), (None, "", None), (3, "é" * 50, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = pack_documents(docs, PATH).toPandas()
    t = Tokenizer.from_file(PATH)
    for doc, text in [(1, "word " * 9000), (3, "é" * 50)]:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in got[got.doc_id == doc].sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert len(got[got.doc_id == 2]) == 2 and got.doc_id.isna().sum() == 1
    total = got.groupby("sequence_id").length.sum()
    assert all(x == 2048 or x & (x - 1) == 0 for x in total)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_a_task_leaves_a_handful_of_fragments(spark, monkeypatch):
    """Small batches go on to the next one: only the last bin of a task may be cut back."""
    from residua.llm import packing

    docs = spark.range(0, 2000, 1, 4).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of document"), "id", F.repeat(F.lit(" more"), (F.col("id") % 120).cast("int"))).alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = pack_documents(docs, PATH).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    total = got.groupby("sequence_id").length.sum()
    task = total.index // packing.SEQUENCES_PER_TASK
    assert (total[total < 2048].groupby(task[total < 2048]).count() <= 11).all()
    assert total.mean() > 1500 and got.length.sum() == got.groupby("doc_id").doc_tokens.first().sum()
    pieces = got.sort_values(["doc_id", "start"])
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 90), st.integers(-5, 120)), max_size=8), max_size=6), st.integers(1, 5), st.integers(1, 32))
def test_batches_of_items(batches, segments, loss):
    """Every token of every item once, within the limits, however the items come in."""
    from residua.llm.packing import _Pool

    pool, out, sizes, heads = _Pool((32, segments, loss), 0), [], [], []
    for batch in batches:
        for n, head in batch:
            pool.add(len(sizes), np.arange(n, dtype="<u4"), head)
            sizes.append(n), heads.append(min(max(head, 0), n))
        out += pool.deal(True).to_pylist()
        assert sum(len(x) - d for x, d in zip(pool.ids, pool.done, strict=True)) < 32
    out += pool.deal(False).to_pylist()
    assert not pool.ids
    for i, n in enumerate(sizes):
        assert sorted(k for p in out if p["doc_id"] == i for k in range(p["start"], p["start"] + p["length"])) == list(range(n))
    for b in {p["sequence_id"] for p in out}:
        mine = sorted((p for p in out if p["sequence_id"] == b), key=lambda p: p["offset"])
        filled = sum(p["length"] for p in mine)
        assert [p["offset"] for p in mine] == [sum(q["length"] for q in mine[:k]) for k in range(len(mine))]
        assert len(mine) <= segments and (filled == 32 or filled & (filled - 1) == 0)
        assert sum(max(0, p["start"] + p["length"] - max(p["start"], heads[p["doc_id"]])) for p in mine) <= loss


def test_odd_prompts(spark):
    rows = [(1, "a b c d", None, None), (2, "a b c d", -4, "q"), (3, "a b", 900, "long prompt of words"), (4, None, 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `n.p` long, lead string")
    t = Tokenizer.from_file(PATH)
    plain = {r.doc_id: r.doc_tokens for r in pack_documents(docs, PATH, 8, 3, 4, prompt_tokens="n.p").collect()}
    assert plain == {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x, *_ in rows}
    led = pack_documents(docs, PATH, 8, 3, 4, prompt="lead").collect()
    assert {r.doc_id: r.doc_tokens for r in led} == {
        i: len(t.encode(p or "", add_special_tokens=False).ids) + len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x, _, p in rows
    }
    for loss in (0, -1):
        with pytest.raises(ValueError):
            pack_documents(docs, PATH, max_loss=loss)


def test_whole_table(spark, sf_dir):
    """Every document's ids by the tokenizer proper, each in one piece, by brute force."""
    docs = table(spark, sf_dir, "documents")
    t, by = Tokenizer.from_file(PATH), {}
    pieces = pack_documents(docs, PATH).collect()
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    rows = docs.collect()
    assert set(by) == {r.doc_id for r in rows}
    for r in rows:
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(by[r.doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for mine in bins.values():
        at = 0
        for offset, length in sorted(mine):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0


def test_instruction_data(spark, sf_dir):
    """The query's examples are the assistant turns after the turn before them, within the loss limit."""
    pieces = queries.instruction_packing(spark, sf_dir).collect()
    t = Tokenizer.from_file(PATH)
    turns = {}
    for r in table(spark, sf_dir, "conversations").collect():
        turns.setdefault((r.conv_id, r.turn), r)
    want = {}
    for (c, n), r in turns.items():
        if r.role == "assistant":
            lead = turns.get((c, n - 1))
            before = len(t.encode((lead.text if lead else None) or "", add_special_tokens=False).ids)
            want[(c << 20) + n] = (before, before + len(t.encode(r.text or "", add_special_tokens=False).ids) + 1)
    got, bearing, segments = {}, {}, {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
        lead = want[p.doc_id][0]
        bearing[p.sequence_id] = bearing.get(p.sequence_id, 0) + max(0, p.start + p.length - max(p.start, lead))
        segments[p.sequence_id] = segments.get(p.sequence_id, 0) + 1
    assert got == {k: n for k, (_, n) in want.items()}
    assert max(bearing.values()) <= queries.MAX_LOSS < 2048 and max(segments.values()) <= 64
