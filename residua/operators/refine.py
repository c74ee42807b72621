"""Choosing primary genes and sequences, and the final tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators.mapping import find_proteins

# The states of a name and the reason given for each when it has no primary sequence.
CODING, PSEUDOGENE, NONCODING = "resolved_protein_coding", "resolved_pseudogene", "resolved_non_protein_coding"
NO_TRANSLATION, AMBIGUOUS, UNRESOLVED = "resolved_no_valid_translation", "ambiguous_but_explained", "unresolved_but_explained"
AVAILABLE = "primary ESM sequence available"
REASONS = {
    AMBIGUOUS: "multiple exact HGNC candidates; no deterministic choice",
    UNRESOLVED: "no exact approved/alias/history/stable-ID evidence",
    PSEUDOGENE: "resolved pseudogene; no primary protein representation",
    NONCODING: "resolved non-protein-coding locus",
}
OTHERWISE = "resolved but no valid primary translation"
SELECTED = "selected_primary_reference_or_MANe_patch"


def classify(mapping: DataFrame, resolution: DataFrame, sequences: DataFrame) -> DataFrame:
    """mapping with resolved symbol, locus and stop classes, policy, primary gene, eligibility and reason.

    sequences: protein_sequence_hash, amino_acid_sequence of all rows, rescued ones included; those without a
    stop may be left out.
    """
    stars = sequences.select("protein_sequence_hash", C.stop_class(F.col("amino_acid_sequence")).alias("star_class"))
    rows = mapping.join(stars, "protein_sequence_hash", "left")
    rows = rows.withColumns(
        {
            "locus_class": C.locus_class(F.col("genomic_region")),
            "star_class": F.coalesce("star_class", F.lit("none")),
            "biotype_policy": C.biotype_policy(F.col("transcript_type")),
        }
    )
    rows = rows.withColumns(
        {
            "sequence_has_stop": F.col("star_class") != "none",
            "is_primary_locus": F.col("locus_class") == "primary_reference",
            "is_patch_exception": F.col("is_mane_select") & (F.col("locus_class") == "patch"),
        }
    )
    rows = rows.withColumn("eligible_locus", F.col("is_primary_locus") | F.col("is_patch_exception"))
    # All that is known of a name goes to its rows in one join.
    names = primary_genes(rows).join(resolution.select("vcc_gene_name", "resolved_symbol"), "vcc_gene_name", "left")
    rows = rows.join(names, "vcc_gene_name", "left").withColumn("resolved_symbol", F.coalesce("resolved_symbol", F.lit("")))
    chosen = F.col("selected_primary_gene_id")
    rows = rows.withColumn("selected_for_primary_locus", (chosen != "") & (F.col("gene_id_stable") == chosen))
    usable = F.col("sequence_valid") & (F.coalesce("protein_sequence_hash", F.lit("")) != "")
    ordinary = F.col("biotype_policy") == "ordinary_protein_coding"
    eligibility = (
        F.when(F.col("sequence_has_stop"), "review")
        .when(~usable, "excluded")
        .when(ordinary & F.col("selected_for_primary_locus"), "primary")
        .when(ordinary | (F.col("biotype_policy") == "special_translated"), "secondary")
        .otherwise("excluded")
    )
    rows = rows.withColumn("eligibility", eligibility)
    primary = F.col("eligibility") == "primary"
    reason = (
        F.when(primary & F.col("is_primary_locus"), "selected_primary_locus")
        .when(primary, "mane_select_patch_exception")
        .when(F.col("sequence_has_stop"), F.col("star_class"))
        .otherwise(F.col("biotype_policy"))
    )
    return rows.withColumn("final_esm_reason", reason)


def primary_genes(rows: DataFrame) -> DataFrame:
    """The one gene of each name on a primary locus; without any, the one patch exception; else ''."""
    def only(flag: str):
        gene = F.when(F.col(flag), F.col("gene_id_stable"))
        return F.min(gene), F.max(gene)

    # One gene is where the least is the largest; a count of distinct ones would lay every row out for each of the flags.
    (primary, last_primary), (patch, last_patch) = only("is_primary_locus"), only("is_patch_exception")
    sums = rows.groupBy("vcc_gene_name").agg(primary.alias("g"), last_primary.alias("g_last"), patch.alias("h"), last_patch.alias("h_last"))
    pick = F.when(F.col("g") == F.col("g_last"), F.col("g")).when(F.col("g").isNull() & (F.col("h") == F.col("h_last")), F.col("h")).otherwise("")
    return sums.select("vcc_gene_name", pick.alias("selected_primary_gene_id"))


def final_sequences(refined: DataFrame, sequences: DataFrame, source: str, release: str) -> DataFrame:
    """One row a primary hash. Raises when read if a hash has no sequence or its sequence another hash."""
    hashes = refined.filter(F.col("eligibility") == "primary").select(F.col("protein_sequence_hash").alias("sequence_hash")).filter(F.col("sequence_hash").isNotNull()).distinct()
    held = sequences.select(F.col("protein_sequence_hash").alias("sequence_hash"), "amino_acid_sequence").distinct()
    rows = hashes.join(held, "sequence_hash", "left")
    s = F.col("amino_acid_sequence")
    same = F.coalesce(C.sequence_hash(s) == F.col("sequence_hash"), F.lit(False))
    checked = F.when(same, s).otherwise(F.raise_error(F.concat(F.lit("no matching sequence for hash "), F.col("sequence_hash"))))
    return rows.select(
        "sequence_hash",
        checked.alias("amino_acid_sequence"),
        F.length(s).alias("protein_length"),
        F.lit(source).alias("sequence_source"),
        F.lit(release).alias("annotation_release"),
        (C.sequence_issue(s) == "").alias("sequence_valid"),
        same.alias("sequence_hash_matches_string"),
    )


def recovered(refined: DataFrame, sequences: DataFrame, index: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Primary hashes that sequences lacks, found again: protein_sequence_hash, amino_acid_sequence.

    They are looked up in index (annotation.protein_index) by the protein ids of their rows, and else by the
    stable ids; only a record of that very hash counts. An index without texts takes them from `texts`
    (protein_sequence_hash, amino_acid_sequence), so they aren't shuffled with every id.
    """
    primary = refined.filter((F.col("eligibility") == "primary") & F.col("protein_sequence_hash").isNotNull())
    wanted = primary.select("protein_sequence_hash", "protein_id", "protein_id_stable").distinct()
    missing = wanted.join(sequences.select("protein_sequence_hash").distinct(), "protein_sequence_hash", "left_anti")
    found = find_proteins(missing, index).filter(F.col("protein.protein_sequence_hash") == F.col("protein_sequence_hash"))
    if texts is not None:
        one = texts.groupBy("protein_sequence_hash").agg(F.min("amino_acid_sequence").alias("amino_acid_sequence"))
        return one.join(found.select("protein_sequence_hash").distinct(), "protein_sequence_hash", "left_semi")
    return found.groupBy("protein_sequence_hash").agg(F.min("protein.amino_acid_sequence").alias("amino_acid_sequence"))


def final_mapping(refined: DataFrame, final: DataFrame) -> DataFrame:
    """refined with validity flags and the final selection."""
    known = final.select(F.col("sequence_hash").alias("protein_sequence_hash"), F.lit(True).alias("_known"))
    rows = refined.join(known, "protein_sequence_hash", "left")
    valid = F.lit(True)
    for c in ("gene_id_stable", "transcript_id_stable", "protein_id_stable", "protein_sequence_hash"):
        valid = valid & F.col(c).isNotNull()
    rows = rows.withColumns(
        {
            "mapping_valid": valid,
            "locus_valid": F.col("eligible_locus"),
            "transcript_biotype_eligible": F.coalesce(F.col("transcript_type") == "protein_coding", F.lit(False)),
            "sequence_hash_in_final": F.col("_known").isNotNull(),
        }
    ).drop("_known")
    rows = rows.withColumn("selected_for_primary_esm", (F.col("eligibility") == "primary") & F.col("sequence_hash_in_final"))
    reason = F.when(F.col("selected_for_primary_esm"), SELECTED).otherwise(F.col("final_esm_reason"))
    return rows.withColumn("final_selection_reason", reason)


def relationships(final_map: DataFrame) -> DataFrame:
    columns = "vcc_gene_name resolved_symbol gene_id transcript_id protein_id mane_status locus_class transcript_type selected_for_primary_esm".split()
    return final_map.filter("selected_for_primary_esm").select(F.col("protein_sequence_hash").alias("sequence_hash"), *columns).distinct()


def final_summary(vocabulary: DataFrame, targets: DataFrame, resolution: DataFrame, complete: DataFrame, final_map: DataFrame) -> DataFrame:
    """Exactly one row a vocabulary name: how it resolved, what it codes for, and what was selected."""
    chosen, primary = F.col("selected_for_primary_esm"), F.col("is_primary_locus")
    sums = final_map.groupBy("vcc_gene_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_or(F.col("gene_type") == "protein_coding").alias("coding"),
        F.bool_or(F.col("gene_type").contains("pseudogene")).alias("pseudo"),
        F.count_distinct(F.when(primary, F.col("gene_id_stable"))).alias("num_primary_gene_loci"),
        F.count_distinct(F.when(chosen, F.col("transcript_id_stable"))).alias("num_primary_transcripts"),
        F.count_distinct(F.when(chosen, F.col("protein_sequence_hash"))).alias("num_primary_unique_protein_sequences"),
        F.bool_or("is_mane_select").alias("MANE_available"),
        F.bool_or(chosen).alias("primary_esm_available"),
    )
    record = complete.select("hgnc_id", F.col("symbol").alias("h_symbol"), "locus_type", "locus_group").dropDuplicates(["hgnc_id"])
    aim = targets.select(F.col("target_gene").alias("vcc_gene_name"), F.lit(True).alias("is_perturbation_target")).distinct()
    rows = vocabulary.select("vcc_gene_name").distinct().join(resolution, "vcc_gene_name", "left").join(record, "hgnc_id", "left")
    rows = rows.join(sums, "vcc_gene_name", "left").join(aim, "vcc_gene_name", "left")
    counts = ["rows", "num_primary_gene_loci", "num_primary_transcripts", "num_primary_unique_protein_sequences"]
    rows = rows.fillna(0, counts).fillna(False, ["coding", "pseudo", "MANE_available", "primary_esm_available", "is_perturbation_target"])
    rows = rows.fillna("", ["h_symbol", "locus_type", "locus_group", "method"])
    kind = F.lower("locus_type")
    pseudo_record = kind.contains("pseudogene") | F.col("h_symbol").endswith("P")
    rna_record = F.lower("locus_group").contains("non-coding") | F.col("locus_type").contains("RNA")
    without_rows = (
        F.when(F.col("method") == "ambiguous_hgnc_token", AMBIGUOUS)
        .when(F.col("method") == "unresolved", UNRESOLVED)
        .when(pseudo_record, PSEUDOGENE)
        .when(rna_record, NONCODING)
        .otherwise(NO_TRANSLATION)
    )
    with_rows = F.when(F.col("coding"), CODING).when(F.col("pseudo"), PSEUDOGENE).otherwise(NONCODING)
    rows = rows.withColumn("gene_resolution_status", F.when(F.col("rows") > 0, with_rows).otherwise(without_rows))
    s = F.col("gene_resolution_status")
    given = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    reason = F.when(F.col("primary_esm_available"), AVAILABLE).otherwise(F.coalesce(F.try_element_at(given, s), F.lit(OTHERWISE)))
    review = s.isin(AMBIGUOUS, UNRESOLVED)
    return rows.select(
        "vcc_gene_name",
        F.col("resolved_symbol").alias("resolved_gene_symbol"),
        F.col("hgnc_id").alias("HGNC_ID"),
        F.col("method").alias("resolution_method"),
        "is_perturbation_target",
        "gene_resolution_status",
        F.when(F.col("coding"), "protein_coding").when(F.col("pseudo"), "pseudogene").otherwise("non_protein_coding_or_unknown").alias("protein_coding_status"),
        *counts[1:],
        "MANE_available",
        "primary_esm_available",
        F.when(s == AMBIGUOUS, "ambiguous").otherwise("not_ambiguous").alias("ambiguity_status"),
        review.alias("review_required"),
        reason.alias("final_reason"),
    )
