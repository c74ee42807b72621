import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from residua.llm import near_dup
from residua.llm.components import connected_components
from residua.session import shared_dir, table, unstage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    posting = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for x in sets[i] for j in posting[x])
        for x in sets[i]:
            posting[x].append(i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_whole_table(spark, sf_dir, words, percent):
    docs = table(spark, sf_dir, "documents")
    assert got(near_dup.near_duplicates(docs, words, percent)) == brute([(r.doc_id, r.text) for r in docs.collect()], words, percent)


def test_large_group_of_variants(spark, monkeypatch):
    """Hundreds of edits of one text: large buckets, a cell of many blocks, chains that only variants close."""
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 40)
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randrange(9)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
        rows.append((1000 - i, " ".join(text)))
    rows += [(i + 2000, base[0] + " " + " ".join(f"y{i}x{k}" for k in range(100))) for i in range(20)]
    want = brute(rows, 3, 85)
    assert 5 < len({v[1] for v in want.values()}) < 250
    assert got(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)) == want


def test_odd_rows(spark):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "A b"), (4, "a  B"), (5, "a"), (6, " \t"), (7, long), (8, long + " end"), (9, "x" * 2_000_000)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in [*rows, (4, "a  B")]], "doc_id long, text string, n int, cell int")
    out = near_dup.near_duplicates(docs, 3, 85)
    assert got(out) == brute(rows, 3, 85) and out.count() == len(rows) + 1
    nameless = spark.createDataFrame([(None, "a b c d"), (None, "q"), (11, "a b c d")], "doc_id long, text string")
    assert sorted((r.component_id or 0, r.kept) for r in near_dup.near_duplicates(nameless, 3, 85).collect()) == [
        (0, False),
        (11, False),
        (11, True),
    ]
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_path_and_loops(spark):
    ids = spark.range(1, 200).select((F.col("id") * 37 % 199).alias("a"), ((F.col("id") + 1) * 37 % 199).alias("b"))
    edges = ids.filter("a <> 0 and b <> 0").unionByName(spark.createDataFrame([(500, 500), (501, 502), (502, 501)], "a long, b long"))
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found.pop(501) == 501 and found.pop(502) == 501 and 500 not in found
    assert len(set(found.values())) <= 2
    assert connected_components(edges.limit(0)).count() == 0


def test_a_large_cell_is_copied_in_proportion(spark):
    """Every set goes to one block, but for a share of pivots that doesn't grow with the cell."""
    for n in (5_000, 50_000):
        blocks = -(-n // near_dup.BLOCK_DOCS)
        members = spark.range(n).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("cell"), F.lit(blocks).alias("blocks"))
        copies = near_dup._places(members).agg(F.sum(F.size("places"))).first()[0]
        assert n <= copies < 1.5 * n


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_prefixes_meet(percent):
    """Two sets at the threshold share one of the shingles looked up and found, wherever the others stand."""
    for small in range(1, 120):
        for large in range(small, 100 * small // percent + 1):
            need = -(-percent * (small + large) // (100 + percent))
            looked, found = near_dup.prefix_lengths(large, percent)[0], near_dup.prefix_lengths(small, percent)[1]
            assert looked >= large - need + 1 and found >= small - need + 1


def test_boilerplate_with_own_words(spark, monkeypatch):
    """A form that hundreds of unlike documents fill in: one cell, few links, found by their prefixes."""
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 16)
    rng = random.Random(5)
    form = [f"f{k}" for k in range(100)]
    rows = []
    for i in range(260):
        at = rng.randrange(60)
        own = [f"o{i // 3}x{k}" for k in range(rng.choice([2, 9, 16]))]
        rows.append((i * 7 % 260, " ".join(form[:at] + own + form[at:])))
    want = brute(rows, 3, 85)
    assert 20 < len({v[1] for v in want.values()}) < 250
    assert got(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)) == want


def test_repeated_ids_with_unlike_texts(spark):
    """One document with several texts, whatever the order of the rows."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (5, a + " end"), (5, b), (6, b + " end"), (7, c), (7, c + " end"), (3, c), (9, "alone now here")]
    for order in (rows, rows[::-1]):
        found = near_dup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string"), 3, 85).collect()
        assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (3, 3), (5, 1), (5, 1), (6, 1), (7, 3), (7, 3), (9, 9)]


def test_nothing_staged_stays_but_the_result(spark):
    """The shared folder holds one table more after a run."""
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    out = near_dup.near_duplicates(spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "e f g h")], "doc_id long, text string"), 3, 85)
    assert len(set(folder.iterdir()) - before) == 1
    unstage(out)
    assert set(folder.iterdir()) == before


MET = "cell long, x long, node long, comp long, n long, place long, found boolean"


def room(a, b, percent):
    """Whether sets of n shingles that first share one at these places can be similar, the smaller one first."""
    (n_a, p_a), (n_b, p_b) = a, b
    need = -(-percent * (n_a + n_b) // (100 + percent))
    return n_a <= n_b and 100 * n_a >= percent * n_b and min(n_a - p_a, n_b - p_b) >= need


@pytest.mark.parametrize("percent", [80, 85])
def test_sizes_lose_no_pair(spark, percent):
    """Every pair that has room meets once, over sizes on both sides of powers of two."""
    sizes = [*range(1, 45), *range(60, 72), 127, 128, 129, 140, 1000, 1023, 1024, 1100]
    at = [(n, p) for n in sizes for p in sorted({0, 1, 2, 3, n // 20, n // 10, n // 8}) if p < n]
    rows = [(0, 0, k, k, n, p, p < near_dup.prefix_lengths(n, percent)[1]) for k, (n, p) in enumerate(at)]
    small, large = near_dup._sized(spark.createDataFrame(rows, MET), percent)
    met = small.join(large, ["cell", "x", "size_a", "size_b"]).select("node_a", "node_b").collect()
    assert len(set(met)) == len(met)
    want = {(i, j) for i, a in enumerate(at) for j, b in enumerate(at) if rows[i][6] and room(a, b, percent)}
    assert want <= {(r.node_a, r.node_b) for r in met}


def test_a_common_shingle_that_comes_too_late_ties_no_pairs(spark):
    """50,000 rows share boilerplate and have two words of their own: just under the line, they never meet."""
    n, places = 20, (2, 3)  # the own shingles are rarer and come first
    rows = spark.range(50_000).selectExpr("0L AS cell", "id AS node", "id AS comp", f"{n}L AS n", "explode(array(0, 1, 2, 3)) AS place")
    rows = rows.selectExpr("cell", "IF(place >= 2, place, node * 4 + place + 10) AS x", "node", "comp", "n", "CAST(place AS LONG) AS place", f"place < {near_dup.prefix_lengths(n, 85)[1]} AS found")
    small, large = near_dup._sized(rows, 85)
    late = F.col("x").isin(*places)
    assert small.filter(late).count() <= 50_000 * 2 and large.filter(late).count() <= 50_000 * 8
    assert small.filter(late).join(large.filter(late), ["cell", "x", "size_a", "size_b"]).count() == 0


def test_boilerplate_under_the_line(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 16)
    form = [f"f{k}" for k in range(20)]
    rows = [(i, " ".join(form + [f"o{i}", f"q{i}"])) for i in range(150)] + [(500 + i, " ".join(form + [f"o{i}"])) for i in range(20)]
    assert got(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)) == brute(rows, 3, 85)
