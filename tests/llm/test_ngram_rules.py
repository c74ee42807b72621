import math
import re
from collections import Counter

import pytest
import xxhash

from residua.llm import ngram_rules as rules
from residua.session import table


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def bucket(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % rules.BUCKETS


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [bucket(w) for w in words] + [bucket(a, b) for a, b in zip(words, words[1:], strict=False)]


def brute(docs, trusted):
    raw, target = Counter(), Counter()
    for i, text in docs:
        found = grams(text)
        raw.update(found)
        if i in trusted:
            target.update(found)
    n_raw, n_target = sum(raw.values()) + rules.BUCKETS, sum(target.values()) + rules.BUCKETS
    out = []
    for i, text in docs:
        found = grams(text)
        llr = 0.0
        if found and any(target.values()):
            llr = sum(math.log((target[b] + 1) / n_target / ((raw[b] + 1) / n_raw)) for b in found) / len(found)
        b = base(text)
        out.append((i, *b, not b[5] and llr >= rules.THRESHOLD, round(llr, 9)))
    return sorted(out, key=str)


def got(rows):
    return sorted(((*tuple(r)[:8], round(r.llr, 9)) for r in rows), key=str)


def test_whole_table(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1}
    assert got(rules.apply_rules(docs, labels).collect()) == brute([(r.doc_id, r.text) for r in docs.collect()], trusted)


@pytest.mark.parametrize("n", [0, 8])
def test_odd_rows(spark, n):
    texts = [None, "", " \t\x0b", "a b c a b c", "w " * 60, "x\n\nx\n y\nx | <y>", "é" * 3 + "  z", "k%d " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)][:n] + [(3, texts[3]), (None, texts[4])][: n // 4]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, words string, llr int")
    labels = spark.createDataFrame([(3, 1), (4, None), (None, 1), (3, 1)], "doc_id long, quality int")
    assert got(rules.apply_rules(docs, labels).collect()) == brute(rows, {3})


def test_all_trusted_documents_count(spark):
    n = 30_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('word', id % 7) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "int(id % 7 < 6) AS quality")
    trusted = rules.trusted_ids(labels)
    assert trusted.count() == sum(k % 7 < 6 for k in range(n))
    ratios = rules.log_ratios(docs, trusted)
    raw, target = Counter(k % 7 for k in range(n)), Counter(k % 7 for k in range(n) if k % 7 < 6)
    shift = math.log(n + rules.BUCKETS) - math.log(sum(target.values()) + rules.BUCKETS)
    for k in range(7):
        assert ratios[bucket(f"word{k}")] == pytest.approx(math.log(target[k] + 1) - math.log(raw[k] + 1) + shift)
