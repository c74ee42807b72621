"""The whole way from annotation files to final tables, on files small enough to follow by hand."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from residua.operators import audit, mapping, refine, resolution
from residua.sources import annotation as A

SEQ = {"P1": "MKV", "P2": "MAC*", "P3": "MKV", "P4": "MZZ", "P5": "M1K", "P6": "MWW"}


def gtf_line(seqname, feature, **attrs):
    return "\t".join([seqname, "x", feature, "1", "2", ".", "+", ".", " ".join(f'{k} "{v}";' for k, v in attrs.items())])


def gene(seqname, g, name, kind="protein_coding"):
    return gtf_line(seqname, "gene", gene_id=g, gene_name=name, gene_type=kind)


def transcript(seqname, g, name, t, p=None, kind="protein_coding"):
    extra = {"protein_id": p} if p else {}
    return gtf_line(seqname, "transcript", gene_id=g, gene_name=name, gene_type="protein_coding", transcript_id=t, transcript_name=t, transcript_type=kind, **extra)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("annotation")
    gtf = [
        "# comment",
        "",
        "too\tshort",
        gene("chr1", "ENSG01.1", "AAA"),
        transcript("chr1", "ENSG01.1", "AAA", "ENST01.1", "ENSP01.1"),
        transcript("chr1", "ENSG01.1", "AAA", "ENST02.1", "ENSP02.1"),
        transcript("chr1", "ENSG01.1", "AAA", "ENST03.1"),
        gene("chr2", "ENSG02.1", "BBB"),
        gene("KI270.1", "ENSG03.1", "BBB"),
        transcript("chr2", "ENSG02.1", "BBB", "ENST04.1", "ENSP03.9"),
        transcript("KI270.1", "ENSG03.1", "BBB", "ENST05.1", "ENSP04.1"),
        gene("chr3", "ENSG04.1", "LNC", "lncRNA"),
        gene("chr4", "ENSG05.1", "NEW"),
        transcript("chr4", "ENSG05.1", "NEW", "ENST06.1", "ENSP06.1"),
        gene("chr5", "ENSG06.1", "BAD"),
        transcript("chr5", "ENSG06.1", "BAD", "ENST07.1", "ENSP05.1"),
    ]
    fasta = [
        f">ENSP0{k[1]}.1|ENST|ENSG|-|-|t|g|3\n{s[:2]}\n{s[2:].lower()}" for k, s in SEQ.items()
    ] + [">broken|header\nMMM"]
    mane = ["Ensembl_nuc\tMANE_status\tRefSeq_nuc\tRefSeq_prot", "ENST01.1\tMANE Select\tNM_1\tNP_1", "ENST01.2\tMANE Plus Clinical\tNM_0\tNP_1", "\tMANE Select\tx\ty"]
    complete = [
        "hgnc_id\tsymbol\tprev_symbol\talias_symbol\tstatus\tensembl_gene_id\tlocus_type\tlocus_group",
        "H:1\tAAA\t\tTWIN\tApproved\tENSG01\tgene with protein product\tprotein-coding gene",
        "H:2\tBBB\tOLDB\tTWIN\tApproved\tENSG02\tgene with protein product\tprotein-coding gene",
        "H:3\tNEW\tOLD | OLDER\t\tApproved\tENSG05\tgene with protein product\tprotein-coding gene",
        "H:4\tRNAX\tOLDR\t\tApproved\t\tRNA, long non-coding\tnon-coding RNA",
    ]
    withdrawn = ["HGNC_ID\tSTATUS\tWITHDRAWN_SYMBOL\tMERGED_INTO_REPORT(S) (i.e HGNC_ID|SYMBOL|STATUS)", "H:9\tMerged\tGONE\tH:3|NEW|Approved", "H:8\tWithdrawn\tLOST\t"]
    for name, lines in {"a.gtf.gz": gtf, "p.fa.gz": fasta, "mane.gz": mane}.items():
        with gzip.open(root / name, "wt") as f:
            f.write("\n".join(lines) + "\n")
    for name, lines in {"complete.txt": complete, "withdrawn.txt": withdrawn}.items():
        (root / name).write_text("\n".join(lines) + "\n")
    return root


NAMES = ["AAA", "BBB", "LNC", "BAD", "OLD", "GONE", "LOST", "TWIN", "NOPE", "OLDR", "ENSG01"]


@pytest.fixture(scope="module")
def built(spark, files):
    vocabulary = spark.createDataFrame([(n,) for n in NAMES], "vcc_gene_name string")
    targets = spark.createDataFrame([("AAA",), ("OLD",)], "target_gene string")
    gtf = A.read_gtf(spark, str(files / "a.gtf.gz"))
    fasta = A.read_fasta(spark, str(files / "p.fa.gz"))
    genes, transcripts = A.gtf_genes(gtf), A.gtf_transcripts(gtf)
    proteins, mane = A.protein_index(A.protein_records(fasta)), A.read_mane(spark, str(files / "mane.gz"))
    complete = A.read_delimited(spark, str(files / "complete.txt"), "\t")
    tokens = A.hgnc_tokens(complete, A.read_delimited(spark, str(files / "withdrawn.txt"), "\t"))
    rows = mapping.build_rows(vocabulary, targets, genes, transcripts, proteins, mane).cache()
    resolved = resolution.resolve(vocabulary, tokens, complete, genes.select("gene_name")).cache()
    rescued = resolved.filter("alias_rescued").select(F.col("resolved_symbol").alias("vcc_gene_name")).distinct()
    extra = mapping.build_rows(rescued, targets, genes, transcripts, proteins, mane)
    table = resolution.rescue(mapping.mapping_table(rows), resolved, extra)
    sequences = A.protein_records(fasta).select("protein_sequence_hash", "amino_acid_sequence").distinct()
    refined = refine.classify(table, resolved, sequences).cache()
    final = refine.final_sequences(refined, sequences, "source", "release").cache()
    final_map = refine.final_mapping(refined, final).cache()
    return locals()


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_sources(spark, files, built):
    report = A.fasta_report(built["fasta"]).first()
    assert (report.total, report.malformed_header, report.with_unusual_characters) == (6, 1, 2)
    assert built["gtf"].count() == 13 and built["genes"].count() == 6
    mane = built["mane"].collect()
    assert [(r.transcript_id_stable, r.is_mane_select, r.is_mane_plus_clinical, r.refseq_transcript_id) for r in mane] == [("ENST01", True, True, "NM_0;NM_1")]
    assert A.check_gtf(built["gtf"]).first().genes == 6
    hashes = A.file_hashes(spark, str(files / "complete.txt")).first()
    assert hashes.sha256 == hashlib.sha256((files / "complete.txt").read_bytes()).hexdigest()


def test_stage_one(built):
    summary = mapping.gene_summary(built["vocabulary"], built["targets"], built["genes"], built["rows"])
    got = by(summary, "vcc_gene_name", "mapping_status", "num_transcripts", "num_unique_protein_sequences", "is_perturbation_target")
    assert len(got) == len(NAMES)
    assert got["AAA"] == ("mapped_with_esm_candidate", 3, 1, True)
    assert got["BBB"][0] == "ambiguous_multiple_gene_ids" and got["LNC"][0] == "non_protein_coding"
    assert got["BAD"][0] == "translated_sequence_invalid" and got["OLD"] == ("gene_symbol_not_found", 0, 0, True)
    kinds = by(summary, "vcc_gene_name", "multi_gene_id_classification")
    assert kinds["BBB"] == "patch_or_alternate_locus" and kinds["AAA"] == ""
    reasons = by(built["rows"], "transcript_id", "exclusion_reason")
    assert reasons["ENST01.1"] == "" and reasons["ENST02.1"] == "invalid_sequence:*" and reasons["ENST03.1"] == "no_translation"
    assert reasons["ENST04.1"] == ""  # found under the stable id
    assert mapping.mapping_table(built["rows"]).columns == mapping.MAPPING_COLUMNS
    sequences = mapping.sequence_table(built["rows"]).collect()
    assert len({r.protein_sequence_hash for r in sequences}) == len(sequences) == 4


def test_resolution(built):
    got = by(built["resolved"], "vcc_gene_name", "method", "resolved_symbol", "hgnc_id")
    assert got["AAA"] == ("approved_symbol", "AAA", "H:1") and got["OLD"] == ("previous_symbol", "NEW", "H:3")
    assert got["GONE"] == ("withdrawn_or_merged_symbol", "NEW", "H:3") and got["LOST"][:2] == ("withdrawn_or_merged_symbol", "")
    assert got["TWIN"][0] == "ambiguous_hgnc_token" and got["NOPE"] == ("unresolved", "NOPE", "")
    assert got["LNC"] == ("exact_gencode_symbol", "LNC", "") and got["ENSG01"] == ("stable_ensembl_id", "AAA", "H:1")
    found = resolution.ambiguous_candidates(built["resolved"], built["tokens"])
    assert {(r.token, r.hgnc_id) for r in found.collect()} == {("TWIN", "H:1"), ("TWIN", "H:2")}


def test_refined_and_final(built):
    refined = built["refined"]
    rescued = {r.vcc_gene_name for r in refined.collect() if r.gene_name_gencode == "NEW"}
    assert rescued == {"OLD", "GONE"}  # every name that resolves to the symbol
    picked = {(r.vcc_gene_name, r.transcript_id): (r.eligibility, r.final_esm_reason) for r in refined.collect()}
    assert picked["AAA", "ENST01.1"] == ("primary", "selected_primary_locus")
    assert picked["AAA", "ENST02.1"] == ("review", "terminal_stop") and picked["AAA", "ENST03.1"][0] == "excluded"
    assert picked["BBB", "ENST04.1"][0] == "primary" and picked["BBB", "ENST05.1"][0] == "secondary"
    final = built["final"].collect()
    assert {r.amino_acid_sequence for r in final} == {"MKV", "MWW"} and all(r.sequence_valid and r.sequence_hash_matches_string for r in final)
    relations = refine.relationships(built["final_map"])
    assert relations.count() == 4
    summary = refine.final_summary(built["vocabulary"], built["targets"], built["resolved"], built["complete"], built["final_map"])
    got = by(summary, "vcc_gene_name", "gene_resolution_status", "primary_esm_available", "review_required")
    assert len(got) == len(NAMES) == summary.count()
    assert got["AAA"] == ("resolved_protein_coding", True, False) and got["TWIN"] == ("ambiguous_but_explained", False, True)
    assert got["NOPE"] == ("unresolved_but_explained", False, True) and got["OLDR"][0] == "resolved_non_protein_coding"


def test_a_missing_sequence_is_an_error(spark, built):
    nothing = spark.createDataFrame([], "protein_sequence_hash string, amino_acid_sequence string")
    with pytest.raises(Exception, match="no matching sequence"):
        refine.final_sequences(built["refined"], nothing, "s", "r").collect()


def test_audit(built):
    relations = refine.relationships(built["final_map"])
    core = audit.integrity(built["final_map"], built["final"], relations).first()
    assert core.sequence_hash_unique and core.missing_sequences == 0 and core.sequences_without_relationship == 0
    isoforms = by(audit.isoforms_per_gene(built["vocabulary"], relations), "vcc_gene_name", "isoforms")
    assert isoforms["AAA"] == 1 and isoforms["NOPE"] == 0
    shared = audit.shared_sequences(relations).collect()
    assert {r.genes for r in shared} == {"AAA|BBB", "GONE|OLD"}
    table = audit.biotypes(built["final_map"], "eligibility").collect()
    assert {r.transcript_type: r.rows for r in table} == {"protein_coding": 8}
    assert audit.stops(built["refined"], built["sequences"]).first().stop_positions == "4"
    targets = audit.targets_review(built["targets"], built["resolved"], built["final_map"])
    assert {r.target_gene: r.primary_sequences for r in targets.collect()} == {"AAA": 1, "OLD": 1}
    bins = audit.length_bins(built["final"], relations)
    assert bins.count() == 7 and bins.filter("sequences > 0").first().genes == 4


def test_later_files_win_whatever_their_size(spark, tmp_path):
    """Spark packs larger files first; order goes by path and place."""

    def gene(name, filler=0):
        return f'chr1\tx\tgene\t1\t2\t.\t+\t.\tgene_id "ENSG1.1"; gene_name "{name}"; gene_type "t";\n' + "# filler\n" * filler

    for k, (name, filler) in enumerate([("A", 0), ("B", 5000), ("C", 10), ("D", 9000)]):
        (tmp_path / f"part-{k}.gtf").write_text(gene(name) + gene(name + "2", filler))
    assert A.gtf_genes(A.read_gtf(spark, str(tmp_path))).first().gene_name == "D2"
    (tmp_path / "fa").mkdir()
    for k, (body, more) in enumerate([("MA", 0), ("MC", 900), ("MD", 30)]):
        records = [f">ENSP1.1|a|b|c|d|e|f|g\n{body}", *[f">Q{k}{n}.1|a|b|c|d|e|f|g\nMMMM" for n in range(more)]]
        (tmp_path / "fa" / f"{k}.fa").write_text("\n".join(records) + "\n")
    index = A.protein_index(A.protein_records(A.read_fasta(spark, str(tmp_path / "fa"))))
    found = {r.key: r.amino_acid_sequence for r in index.filter("key like 'ENSP%'").collect()}
    assert found == {"ENSP1.1": "MD", "ENSP1": "MA"}


def test_order_holds_across_the_splits_of_a_file(spark, tmp_path):
    line = 'chr1\tx\tgene\t1\t2\t.\t+\t.\tgene_id "ENSG{}.1"; gene_name "{}"; gene_type "t";\n'
    (tmp_path / "big.gtf").write_text("".join(line.format(k % 50, k) for k in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.gene_id_stable: r.gene_name for r in A.gtf_genes(A.read_gtf(spark, str(tmp_path))).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"ENSG{k}": str(4950 + k) for k in range(50)}
