import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from residua.llm import collocations as c

SCHEMA = "lang string, text string"


def brute(rows, least, top=c.TOP):
    """All phrases counted in plain Python."""
    lower = {k: k + 32 for k in range(65, 91)}
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = []
    for lang in n:
        mine = {p: a for (x, p), a in f.items() if x == lang and a >= least}
        found = []
        for p, a in mine.items():
            if len(p) < 2:
                continue
            if any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in mine.items()
            ):
                continue
            score, k = min((2_000_000 * a // (mine[p[:k]] + mine[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def run(spark, rows, least, **options):
    df = spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)
    return sorted(map(tuple, c.collocations(df, least, **options).collect()))


ODD = [
    (None, "New York is new york, New York!"),
    ("und", "new\tyork  is here"),
    ("en", None),
    ("fr", ""),
    ("en", "a b c d e a b c d e. a b c d"),
    ("en", "a b c d e a b c d e. a b c d"),
    ("en", "x x x x x x x ÀÉ ÀÉ ÀÉ \x00 \x00 \x00"),
    ("de", "straße straße\x0bstraße straße\x85   .;:!?"),
    ("", "p q p q p q"),
]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_odd_texts(spark, least):
    assert run(spark, ODD, least) == brute(ODD, least)


def test_long_texts_are_cut_without_loss(spark):
    words = [f"w{k * k % 7}" for k in range(400)]
    text = " ".join(words) + "." + " ".join(words[:50]) + " " + "y" * 300 + " z " + "y" * 300 + " z"
    rows = [("en", text), ("fr", "y" * 500), ("en", ",,, a ,,," * 30), ("en", "a\tb  c " * 40)]
    for chunk in (8, 37, 200):
        assert run(spark, rows, 3, chunk=chunk) == brute(rows, 3)


def test_ties_top_and_clashing_columns(spark):
    rows = [("en", "b a. c a. d a. e a")] * 4 + [("en", "z z. y y")] * 4
    assert run(spark, rows, 4, top=3) == brute(rows, 4, 3)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("lang", "text", "1 as f", "2 as phrase", "3 as words", "4 as `_part`", "5 as n")
    assert sorted(map(tuple, c.collocations(df, 4).collect())) == brute(rows, 4)


def test_empty_table_and_limits(spark):
    assert run(spark, [], 2) == []
    with pytest.raises(ValueError):
        run(spark, [("en", "a")], 0)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    rows = [("en", 2, "a b", big - 1), ("en", 1, "a", big), ("en", 1, "b", big + 7)]
    frequent = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    assert c._scored(frequent).first().score == 2_000_000 * (big - 1) // (2 * big + 7)


def test_the_sketch_loses_no_frequent_phrase(spark):
    """Few counters, so that many cells are shared: more gets through, and the same is left."""
    rows = [("en", " ".join(f"w{(k * j) % 97}" for k in range(300))) for j in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    few = c.frequent_phrases(df, 5, bits=28)
    want = Counter()
    for _, text in rows:
        w = text.split()
        for n in range(1, 5):
            want.update((n, " ".join(w[i : i + n])) for i in range(len(w) - n + 1))
    got = {(r.words, r.phrase): r.f for r in few.filter(F.col("words") > 0).collect()}
    assert got == {k: v for k, v in want.items() if v >= 5}
