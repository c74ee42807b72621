import json

from pyspark.sql import functions as F

from residua.cli import main
from tests.test_mapping import NAMES, files  # noqa: F401  (a fixture)


def test_map(spark, files, tmp_path):  # noqa: F811
    (tmp_path / "names.csv").write_text("gene_name\n" + "\n".join(NAMES) + "\n")
    (tmp_path / "targets.csv").write_text("target_gene\nAAA\nOLD\n")
    out = str(tmp_path / "out")
    made = main(
        ["map", "--vocabulary", str(tmp_path / "names.csv"), "--targets", str(tmp_path / "targets.csv"), "--gtf", str(files / "a.gtf.gz"),
         "--fasta", str(files / "p.fa.gz"), "--mane", str(files / "mane.gz"), "--complete", str(files / "complete.txt"),
         "--withdrawn", str(files / "withdrawn.txt"), "--out", out],
        spark,
    )
    assert "gene_mapping_summary_final" in made
    assert spark.read.parquet(f"{out}/gene_mapping_summary_final").count() == len(NAMES)
    assert {r.amino_acid_sequence for r in spark.read.parquet(f"{out}/sequences_final").collect()} == {"MKV", "MWW"}
    qc = json.loads((tmp_path / "out" / "mapping_final_qc.json").read_text())
    assert qc["missing_sequences"] == 0 and qc["sequence_rows"] == 2


def test_shards_and_extraction(spark, tmp_path):
    rows = spark.range(23).select(
        F.sha2(F.col("id").cast("string"), 256).alias("sequence_hash"),
        F.repeat(F.lit("MKVL"), (F.col("id") * 30 + 1).cast("int")).alias("amino_acid_sequence"),
    )
    source, root, out = (str(tmp_path / x) for x in ("in", "shards", "banks"))
    rows.write.parquet(source)
    made = main(["shard", "--input", source, "--output-dir", root, "--shard-size", "10"], spark)
    assert made["total_rows"] == 23 and "shards" not in made
    first = main(["run-shards", "--input-root", root, "--output-root", out, "--limit", "2"], spark)
    assert [r["state"] for r in first] == ["done", "done"]
    second = main(["run-shards", "--input-root", root, "--output-root", out], spark)
    assert [r["state"] for r in second] == ["already_valid", "already_valid", "done"]
    assert second[2]["completed"] == 3
    bank = str(tmp_path / "bank")
    assert main(["extract", "--input", source, "--output", bank], spark) == {"completed": 23, "failed": 0}
    assert main(["extract", "--input", source, "--output", bank, "--disable-batching"], spark) == {"completed": 23, "failed": 0}
    some = str(tmp_path / "some")
    assert main(["extract", "--input", source, "--output", some, "--features", "mean", "parti"], spark) == {"completed": 23, "failed": 0}
    assert spark.read.parquet(some).columns[-2:] == ["mean", "parti"] and "std" not in spark.read.parquet(some).columns
    assert main(["extract", "--input", source, "--output", some], spark) == {"completed": 23, "failed": 0}
    assert spark.read.parquet(some).filter("std IS NOT NULL").count() == 23
    timed = main(["benchmark", "--input", source, "--count", "8", "--max-tokens", "4096"], spark)
    assert timed[1]["least_cosine"] > 0.999999 and len(timed) == 2
    assert all(r["residues_per_second"] > r["per_hour"] / 3600 > 0 for r in timed)


def test_compare_pagerank(spark, tmp_path):
    spark.createDataFrame([("a", "MKVLA"), ("b", "MKV")], "sequence_hash string, amino_acid_sequence string").write.parquet(str(tmp_path / "in"))
    got = main(["compare-pagerank", "--input", str(tmp_path / "in"), "--count", "2"], spark)
    assert len(got) == 2 and all(r["max_abs_error"] < 1e-9 for r in got)
