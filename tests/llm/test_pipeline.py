from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from residua.llm import mixing, ngram_rules, quality
from residua.session import staged, table
from tests.llm import test_near_dup, test_ngram_rules


def test_stages_against_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    good = {i for i, r in rows.items() if model.score(r.text) >= quality.THRESHOLD}
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1}
    judged = test_ngram_rules.brute([(i, rows[i].text) for i in good], trusted)
    passed = {r[0] for r in judged if r[7]}
    groups = test_near_dup.brute([(i, rows[i].text) for i in passed], 5, 80)
    want = {i for i, g in groups.items() if g[2]}
    assert 0 < len(want) < len(rows)

    now = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = staged(stage(spark, now, sf_dir), name)
        assert now.columns == docs.columns
        kept.append({r.doc_id: r for r in now.collect()})
    assert [set(k) for k in kept] == [good, passed, want, want]
    assert all(k[i] == rows[i] for k in kept for i in k)
    place = {r.doc_id: (r.slot, r.start) for r in mixing.mix(docs.filter(docs.doc_id.isin(list(want)))).collect()}
    order = [r.doc_id for r in corpus_pipeline.source_mixing(spark, now, sf_dir).collect()]
    assert order == sorted(want, key=place.get)

    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    by = defaultdict(list)
    for p in pieces:
        by[p.doc_id].append((p.start, p.length, p.doc_tokens))
    assert set(by) == want
    for parts in by.values():
        at = 0
        for start, length, _ in sorted(parts):
            assert start == at
            at += length
        assert at == parts[0][2]
    assert ngram_rules.THRESHOLD < 0


def test_odd_documents(spark, tmp_path):
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, text), (1, text), (None, text), (None, text + " more"), (2, None), (3, ""), (4, "short")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = [p.doc_id for p in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(set(ids), key=str) == [1, None]
    now = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        now = staged(stage(spark, now, str(tmp_path)), name)
        assert now.count() == 0


def test_clashing_columns(spark, tmp_path):
    """Columns named as the stages' own, or with a dot, come out of every stage as they went in."""
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, text), (2, text + " more"), (3, " ".join(f"other{k}" for k in range(80))), (None, "nameless " * 60), (None, "nameless " * 60)]
    names = "_kept _text _trusted _source row id digest kept a.b score slot start mass".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame([(i, t, "en", "s", 1, *range(len(names))) for i, t in rows], schema)
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, str(tmp_path)), name)
        assert out.columns == docs.columns
        if name == "near_duplicates":
            assert sorted((r.doc_id for r in out.collect()), key=str) == [1, 3, None]
        if name == "source_mixing":
            assert out.count() == len(rows)
    with_map = docs.withColumn("tags", F.create_map(F.lit("k"), F.col("score")))
    assert corpus_pipeline.near_duplicates(spark, with_map, str(tmp_path)).count() == 3
