import zlib
from collections import Counter, defaultdict
from heapq import heappop, heappush

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm import sharding as s

SCHEMA = "doc_id long, text string"


def held(rows, found, shards):
    """The contract's rules, for (doc_id, text) rows; returns the shards' bytes."""
    size = [len((t or "").encode()) + 1 for _, t in rows]
    want = Counter((d, n, zlib.crc32((t or "").encode()), "bytes", None) for (d, t), n in zip(rows, size, strict=True))
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in found) == want
    slots, groups, loads = defaultdict(list), defaultdict(set), Counter()
    for r in found:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        groups[r.text_crc32].add(r.shard)
        loads[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in groups.values())
    return [loads[k] for k in range(shards)]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.tuples(st.integers(1, 40), st.integers(0, 30)), max_size=8), st.integers(1, 9))
def test_stretches_are_the_heaps_choices(classes, shards):
    rows = [(name, n, name * n + min(more, n)) for name, (n, more) in classes.items()]
    heap = [(0, k) for k in range(shards)]
    plan = s.schedule(rows, shards)
    for name, n, total in sorted(rows, reverse=True):
        want = []
        for _ in range(n):
            load, k = heappop(heap)
            want.append(k)
            heappush(heap, (load + total // n, k))
        assert [turn[(i - at) % len(turn)] for at, to, turn in plan[name] for i in range(at, to)] == want


def test_a_run_of_any_length_is_a_few_stretches():
    n = 10**12
    plan = s.schedule([(1 << 45, 1, 1 << 45), (2000, n, 2000 * n), (3, 7, 21)], 8)
    assert len(plan[2000]) <= 9
    assert plan[2000][-1][1] == n


def test_odd_rows(spark):
    rows = [(1, None), (None, None), (2, ""), (3, "é" * 50_000), (None, "a"), (None, "a"), (4, "a"), (4, "a"), (5, "b"), (6, "c\x00")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "1 as digest", "2 as salt", "3 as `class`", "4 as bytes", "'x' as `row`", "5 as shard")
    loads = held(rows, s.assign(df, 3).collect(), 3)
    assert max(loads) == 100_001
    assert s.assign(spark.createDataFrame([], SCHEMA), 3).collect() == []
    with pytest.raises(ValueError):
        s.assign(df, 0)


def test_a_group_of_a_third_and_many_of_one_size(spark):
    rows = [(k, "copy of a text") for k in range(700)] + [(700 + k, f"text {k:05d}") for k in range(1300)]
    rows += [(2000 + k, f"{k} " * (20_000 + 7 * k)) for k in range(9)]
    found = s.assign(spark.createDataFrame(rows, SCHEMA), 4).collect()
    loads = held(rows, found, 4)
    largest = max(len(t.encode()) + 1 for _, t in rows)
    assert max(loads) - min(loads) <= 2 * largest
    same = [r for r in found if r.doc_id < 700]
    assert len({r.shard for r in same}) == 1
    at = sorted(r.slot for r in same)
    assert at == list(range(at[0], at[0] + 700))  # a group stands together


def test_ties_are_dealt_the_same_way_again(spark):
    rows = [(k, f"t{k % 50:02d}") for k in range(200)]
    a = s.assign(spark.createDataFrame(rows, SCHEMA), 4).collect()
    b = s.assign(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), 4).collect()
    assert sorted(a) == sorted(b)


def test_other_groups_and_files(spark, tmp_path):
    rows = [(k, f"text {k}", f"site {k % 5}", -k) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, site string, shard int")
    for _ in range(2):  # a second run overwrites the first
        s.write_shards(df, str(tmp_path / "out"), 3, group="site", file_rows=7)
    back = spark.read.parquet(str(tmp_path / "out"))
    got = back.collect()
    assert sorted((r.doc_id, r.text, r.site, r._shard) for r in got) == rows
    homes = defaultdict(set)
    for r in got:
        homes[r.site].add(r.shard)
    assert all(len(v) == 1 for v in homes.values())
    assert all(spark.read.parquet(f).count() <= 7 for f in back.inputFiles())
    for f in back.inputFiles():
        slots = [r.slot for r in spark.read.parquet(f).collect()]
        assert slots == sorted(slots) and slots[-1] // 7 == slots[0] // 7
