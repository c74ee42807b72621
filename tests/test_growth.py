"""Steps whose work must grow no faster than their input."""

import functools
import itertools

import pytest
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators import mapping, refine
from residua.plans import annotation, chain
from residua.sources import annotation as A


def test_a_line_of_annotation_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('chr1\tx\tgene\t1\t2\t.\t+\t.\tgene_id "ENSG1.1"; level 2; tag "a"; tag "b"; gene_name "N";x "y"\n')
    gtf = A.read_gtf(spark, str(tmp_path))
    plan = A.gtf_genes(gtf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2  # keys and values
    assert gtf.first().attrs == {"gene_id": "ENSG1.1", "tag": "b", "gene_name": "N", ";x": "y"}


def test_the_last_of_many_equal_keys(spark):
    rows = spark.range(50).select(F.expr("array_join(transform(sequence(1, 1000), i -> 'k' || (i % 7) || ' \"' || i || '\"'), ' ')").alias("a"))
    got = {(r.key, r.value) for r in rows.select(F.explode(C.attributes(F.col("a")))).collect()}
    assert got == {(f"k{i % 7}", str(i)) for i in range(994, 1001)}


@pytest.mark.parametrize(("given", "want"), [("ENSG1.2", "ENSG1"), ("ENSP7", "ENSP7"), ("ENST1.2\n", "ENST1"), ("ENSG1.x", "ENSG1.x"), ("xENSG1.2", "xENSG1.2"), ("", None), (None, None)])
def test_stable_ids(spark, given, want):
    assert spark.createDataFrame([(given,)], "a string").select(C.stable_id(F.col("a"))).first()[0] == want


def test_a_query_makes_only_what_it_rests_on(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(chain, "_built", {})
    assert chain.map_genes(spark, sf_dir).count() > 0
    assert set(chain.built(spark, sf_dir).made) == {"genes"}
    chain.audit_ambiguous(spark, sf_dir).count()
    assert set(chain.built(spark, sf_dir).made) == {"genes", "gene_resolution"}


def test_texts_are_looked_up_by_hash(spark, sf_dir):
    run = chain.built(spark, sf_dir)
    assert "amino_acid_sequence" not in run.proteins.columns
    rows = mapping.build_rows(run.vocabulary, run.targets, run["genes"], run["transcripts"], A.protein_index(run["protein_records"]), run["mane"])
    want = {tuple(r) for r in mapping.sequence_table(rows).collect()}
    got = mapping.sequences_of(run["gene_protein_mapping"], run["protein_records"])
    assert {tuple(r) for r in got.select(*mapping.sequence_table(rows).columns).collect()} == want


def test_files_are_dealt_out(spark, sf_dir, tmp_path):
    """A gzipped file is read by one task, so lines must not lie in the few files that a join leaves."""
    files = chain._Files(spark, sf_dir, str(tmp_path))
    for path in (files.gtf, files.vocabulary, files.complete):
        sizes = sorted(r.length for r in spark.read.format("binaryFile").load(path).select("length").collect())
        assert files.parts % spark.sparkContext.defaultParallelism == 0
        assert len(sizes) >= files.parts and sizes[-1] < 3 * sum(sizes) / files.parts


def test_an_issue_is_worked_out_once_and_records_are_indexed_in_one_pass(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">ENSP1.1|b|c|d|e|f|g|h\n m>k \n\tA*\n>ENSP1.2|b|c|d|e|f|g|h\nMM\n>ENSP1|b|c|d|e|f|g|h\nMK\n")
    records = A.protein_records(A.read_fasta(spark, str(tmp_path)))
    assert records._jdf.queryExecution().optimizedPlan().toString().count("array_distinct") == 1
    got = {r.protein_id: (r.amino_acid_sequence, r.sequence_valid, r.sequence_issue) for r in records.collect()}
    assert got == {"ENSP1.1": ("M>KA*", False, "*;>"), "ENSP1.2": ("MM", True, ""), "ENSP1": ("MK", True, "")}
    index = A.protein_index(records)
    assert index._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert {r.key: r.amino_acid_sequence for r in index.collect()} == {"ENSP1.1": "M>KA*", "ENSP1.2": "MM", "ENSP1": "MK"}


def test_rows_without_an_id_are_spread(spark):
    rows = spark.range(10_000).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("protein_id"), F.lit(None).cast("string").alias("protein_id_stable"))
    index = spark.createDataFrame([("a", 1), (None, 2)], "key string, n int").hint("merge")
    found = mapping.find_proteins(rows, index)
    assert found.filter("protein is null").count() == 10_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_record_is_cut_into_lines_once(spark, tmp_path):
    (tmp_path / "a.fa").write_text(" \n>ENSP1.1|b|c|d|e|f|g|h\n m k \n\n\tA\x0b\n>no lines|>x\n>>ENSP2|b|c|d|e|f|g|h\nM K\r\n")
    fasta = A.read_fasta(spark, str(tmp_path))
    assert _plan(fasta).count("split(value") + _plan(fasta).count("split(CASE") == 1 and "instr(" not in _plan(fasta)
    got = [(r.header[0], r.malformed, r.sequence) for r in fasta.orderBy("record_no").collect()]
    assert got == [("ENSP1.1", False, "M KA"), ("no lines", True, ""), ("ENSP2", False, "M K")]


def test_letters_in_order_are_not_taken_apart(spark):
    rows = spark.createDataFrame([("MK",), ("",), ("  ",), (None,), ("M*K1*",)], "s string")
    found = rows.select(C.sequence_issue(F.col("s")).alias("i"))
    assert "RLIKE" in _plan(spark.range(1).selectExpr("cast(id as string) s").select(C.sequence_issue(F.col("s"))))
    assert [r.i for r in found.collect()] == ["", "empty_sequence", "empty_sequence", "empty_sequence", "*;1"]


def test_primary_genes_do_not_lay_rows_out_for_each_flag(spark):
    rows = [("a", "G1", True, False), ("a", "G1", True, False), ("b", "G1", True, False), ("b", "G2", True, True), ("c", "G3", False, True), ("c", None, True, False), ("d", "G4", False, False), ("e", "G5", False, True), ("e", "G6", False, True)]
    found = refine.primary_genes(spark.createDataFrame(rows, "vcc_gene_name string, gene_id_stable string, is_primary_locus boolean, is_patch_exception boolean"))
    assert "Expand" not in _plan(found)
    assert {tuple(r) for r in found.collect()} == {("a", "G1"), ("b", ""), ("c", "G3"), ("d", ""), ("e", "")}


def test_rows_are_rescued_for_missing_symbols_only(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(chain, "_built", {})
    seen, staged = {}, annotation.staged
    monkeypatch.setattr(annotation, "staged", lambda df, name: seen.setdefault(name, staged(df, name)))
    run = chain.built(spark, sf_dir)
    assert run["gene_protein_mapping_refined"].count() > run["gene_protein_mapping"].count()
    have = run["gene_protein_mapping"].select("gene_name_gencode")
    assert seen["rescued"].count() > 0 and seen["rescued"].join(have, "gene_name_gencode", "left_semi").isEmpty()


def test_plain_attributes_are_told_from_the_text(spark, tmp_path):
    """As the map tells them, for any line; the map is made for odd lines only."""
    parts = ['gene_id "G1";', 'gene_id "";', 'gene_name "a gene_id ";', 'gene_name " x";', 'gene_name "; gene_id";', "level 2;", 'note "gene_id";', 'x"gene_id "G2";', 'gene_id  "G3";', ';gene_id "G4";', '"', 'gene_type "t"', "gene_id"]
    odd = {parts[i] for i in (2, 7, 8)}
    lines = [sep.join(p) for n in (1, 2, 3) for p in itertools.product(parts, repeat=n) for sep in (" ", "")]
    rows = spark.createDataFrame([(f" {x}",) for x in lines], "text string").withColumn("odd", F.when(~F.col("text").rlike(C.PLAIN_ATTRIBUTES), C.attributes(F.col("text"))))
    keys = (("gene_id",), ("gene_name",), ("gene_type", "gene_name"), (";gene_id",))
    wrong = [C.attribute(*k) != C.first_attribute(C.attributes(F.col("text")), *k) for k in keys]
    assert rows.filter(functools.reduce(lambda a, b: a | b, wrong)).count() == 0
    plain = {r.text for r in rows.filter("odd is null").collect()}
    assert ' gene_id "G1"; level 2; gene_id "";' in plain and not any(x in r for x in odd for r in plain)
    (tmp_path / "a.gtf").write_text('chr1\tx\tgene\t1\t2\t.\t+\t.\tgene_id "ENSG1.1"; level 2; gene_name "N";\n')
    assert A.gtf_genes(A.read_gtf(spark, str(tmp_path))).first()[:3] == ("ENSG1.1", "ENSG1", "N")


def test_a_record_is_shuffled_once_for_its_index(spark):
    records = spark.createDataFrame([("ENSP1.1", "ENSP1", 1, "h")], "protein_id string, protein_id_stable string, record_no int, protein_sequence_hash string")
    index = A.protein_index(records.repartition(2))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = index.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("hashpartitioning(") == 1 and plan.index("Generate") < plan.index("hashpartitioning(")


def test_records_are_found_by_one_shuffle_as_by_their_index(spark, tmp_path):
    """Versions, an exact id that is also a stable one, ids without a form, and none."""
    ids = ["ENSP1.1", "ENSP1.2", "ENSP1.1", "ENSP2", "ENSP2.1", "ENSP2", "ENSP3.4", "x.1", "x", ""]
    records = spark.createDataFrame([(x, i, f"h{i}") for i, x in enumerate(ids)], "protein_id string, record_no int, protein_sequence_hash string").withColumn("protein_id_stable", C.stable_id(F.col("protein_id")))
    asked = spark.createDataFrame([(x,) for x in [*ids[:-1], "ENSP1", "ENSP1.9", "ENSP2.9", "ENSP3", "x.2", "ENSP9", None, None]], "protein_id string").withColumn("protein_id_stable", C.stable_id(F.col("protein_id")))
    want = {(r.protein_id, r.protein and r.protein.protein_sequence_hash) for r in mapping.find_proteins(asked, A.protein_index(records)).collect()}
    found = mapping.find_proteins(asked.hint("merge"), records)
    assert found.count() == asked.count() and {(r.protein_id, r.protein and r.protein.protein_sequence_hash) for r in found.collect()} == want
    assert {("ENSP1.1", "h2"), ("ENSP1.9", "h0"), ("ENSP2.9", "h5"), ("x", "h8"), ("x.2", None), (None, None)} < want
    asked.write.parquet(str(tmp_path / "asked"))
    records.write.parquet(str(tmp_path / "records"))
    asked, records = spark.read.parquet(str(tmp_path / "asked")), spark.read.parquet(str(tmp_path / "records"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = mapping.find_proteins(asked.hint("merge"), records)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("+- Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
