import itertools
import pickle
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm import labelled, quality, toxicity
from residua.session import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_is_the_edit_distance():
    terms = ["abc", "abcde", "bcdea", "aabbb"]
    automaton = toxicity.LexiconAutomaton(terms)
    for n in (2, 3, 4, 5, 6):
        for word in map("".join, itertools.islice(itertools.product("abcde", repeat=n), 0, 16000, 3)):
            want = min(
                ((d, t) for t in terms if (d := distance(word, t)) <= (1 if len(t) >= 5 else 0)), default=None
            )
            got = automaton.find(word)
            assert (got and (got[0], automaton.terms[got[1]])) == want, word


def test_quotation_lowers_the_score():
    model = toxicity.Model(["horrid"], toxicity.train([]).weight)
    model = pickle.loads(pickle.dumps(model))
    plain, quoted = model.score("you are a horrid person"), model.score('they said "you are a horrid person" once')
    near = model.score("you are a horid person")
    assert plain > quoted > model.score("you are a person") and plain > near > model.score("")


def test_quality_learns_and_handles_odd_rows():
    good = [(f"the sea was calm on day {k} and the boats went out", 1) for k in range(30)]
    bad = [(f"BUY {k} NOW!!! $$$ ### click", 0) for k in range(30)]
    model = quality.train(good + bad)
    assert model.score("the boats were calm") > 0.5 > model.score("BUY $$$ NOW!!!")
    assert 0 <= model.score(None) <= 1 and model.score(None) == model.score("")
    assert model.score("calm sea " * 200_000) > 0.5
    assert quality.train([]).score("x") == 0.5
    assert quality.train(good).score("x") > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_tables(spark, module):
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, "", "y"), (None, "some text", None), (4, "some text", "z"), (4, "some text", "z")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame(
        [(4, 1, None), (None, 1, 1), (4, 0, 1), (1, None, 0)], "doc_id long, quality int, toxic int"
    )
    rows = module.classify(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    empty = docs.limit(0)
    assert module.classify(empty, labels.limit(0)).count() == 0


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.85)])
def test_held_out_accuracy(spark, module, label, least):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r.doc_id: r for r in module.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    right = [
        got[r.doc_id].predicted == r[label]
        for r in labels.collect()
        if zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.KEPT_BACK
    ]
    assert all(
        r.held_out == (zlib.crc32(str(i).encode()) % module.FOLDS == module.KEPT_BACK) for i, r in got.items()
    )
    assert sum(right) / len(right) >= least


def test_only_near_copies_count_once():
    shared = min((f"word{k}" for k in range(5000)), key=lambda w: zlib.crc32(w.encode()))
    plain = [(f"{shared} " + " ".join(f"plain{k}x{j}" for j in range(20)), 0) for k in range(40)]
    unlike = [(f"{shared} horrid " + " ".join(f"toxic{k}x{j}" for j in range(20)), 1) for k in range(40)]
    assert toxicity.learn_lexicon(plain + unlike) == ["horrid"]
    copies = [(" ".join(f"same{j}" for j in range(40)) + f" copy{k}", 1) for k in range(40)]
    assert toxicity.learn_lexicon(plain + unlike + copies) == ["horrid"]
    sets = [frozenset(range(k, k + n)) for k in range(0, 60, 3) for n in (5, 20, 21, 24)]
    sets = [frozenset(map(str, s)) for s in sets]
    groups = toxicity.near_copies(sets)
    firsts = [g[0] for g in groups]
    assert sum(map(len, groups)) == len(sets)
    assert all(5 * len(g[0] & s) >= 4 * len(g[0] | s) for g in groups for s in g)
    assert not any(5 * len(a & b) >= 4 * len(a | b) for a, b in itertools.combinations(firsts, 2))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\té", max_size=60), st.integers(1, 9))
def test_slices_leave_features_alone(text, size):
    whole = sorted(np.concatenate(list(quality.grams(text))).tolist())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "SLICE", size)
        assert sorted(np.concatenate(list(quality.grams(text))).tolist()) == whole


def test_features_by_brute_force():
    """The n-grams and words of a text, hashed one at a time."""
    text = "one  two two\tthree é"
    found = Counter(np.concatenate(list(quality.grams(text))).tolist())
    padded = f"\n{text}\n"
    words = text.split()
    assert sum(n for k, n in found.items() if k == quality.REPEAT) == 1
    assert sum(n for k, n in found.items() if quality.NGRAMS <= k < quality.REPEAT) == len(words)
    assert sum(n for k, n in found.items() if k < quality.NGRAMS) == 2 * len(padded) - 5
    want = Counter()
    for w in words:
        h = sum(ord(c) * pow(0x100000001B3, j) for j, c in enumerate(w)) % 2**64
        want[(h * 0x9E3779B97F4A7C15 % 2**64 >> 48) + quality.NGRAMS] += 1
    for n in (3, 4):
        for k in range(len(padded) - n + 1):
            h = 0
            for c in padded[k : k + n]:
                h = (h * 0x01000193 + ord(c)) % 2**32
            want[h * 0x9E3779B1 % 2**32 >> 16] += 1
    want[quality.REPEAT] = 1
    assert found == want


def test_a_text_too_large_is_skipped_not_the_rest(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "x" * (900 if k == 7 else 10)) for k in range(40)] + [(3, "second")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    usable = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5]
    assert 7 in usable and 3 in usable
    assert len(labelled.sample(docs, labels, "quality", 5, 0)) == len(usable)
    monkeypatch.setattr(labelled, "MAX_CHARS", 500)
    assert len(labelled.sample(docs, labels, "quality", 5, 0)) == len(usable) - 1
    monkeypatch.setattr(labelled, "MAX_TEXT", 800)
    found = labelled.sample(docs, labels, "quality", 5, 0)
    assert len(found) == len(usable) - 1 and {y for _, y in found} == {0, 1}


@pytest.mark.parametrize("module,label,other", [(quality, "quality", "toxic"), (toxicity, "toxic", "quality")])
def test_whole_table_row_by_row(spark, sf_dir, module, label, other):
    """The query's rows are those of the model applied to each text in plain Python."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = module.train(labelled.sample(docs, labels, label, module.FOLDS, module.KEPT_BACK))
    want = {}
    for r in docs.collect():
        score = model.score(r.text)
        want[r.doc_id] = (zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.KEPT_BACK, score, int(score >= module.THRESHOLD))
    assert {r.doc_id: (r.held_out, r.score, r.predicted) for r in module.classify(docs, labels).collect()} == want


def test_hits_of_a_long_text(monkeypatch):
    model = toxicity.Model(["horrid", "nasty"], np.zeros(5))
    text = ("they said so and horrid things " * 7 + "a \"horrid\" one\n" + "x" * 300 + " nasty\tnastyy ") * 3
    whole = model.hits(text)
    assert len(whole[1]) == 30 and {e for _, e, _ in whole[1]} == {0, 1} and {q for _, _, q in whole[1]} == {False, True}
    for size in (1, 7, 50, 299, 1000):
        monkeypatch.setattr(toxicity, "SLICE", size)
        assert toxicity.Model(["horrid", "nasty"], np.zeros(5)).hits(text) == whole
    assert model.hits("horrid " * 300_000)[0] == 300_000
