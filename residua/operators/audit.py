"""Reports on the final tables; each is one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators import checks

#: Values that a crosstab makes columns of, at most.
MOST_KINDS = 1000


def _set(column: str):
    return F.array_join(F.array_sort(F.collect_set(column)), "|")


def _one_row(*parts: DataFrame) -> DataFrame:
    """Single-row tables side by side."""
    keyed = [df.withColumn("_one", F.lit(1)) for df in parts]
    out = keyed[0]
    for df in keyed[1:]:
        out = out.join(df, "_one")
    return out.drop("_one")


def integrity(final_map: DataFrame, final: DataFrame, relations: DataFrame) -> DataFrame:
    """One row of sizes, and of counts that should be zero or true."""
    primary = final_map.filter(F.col("eligibility") == "primary").select(F.col("protein_sequence_hash").alias("sequence_hash")).distinct()
    known = final.select("sequence_hash", F.lit(True).alias("_f")).distinct()
    linked = relations.select("sequence_hash", F.lit(True).alias("_r")).distinct()
    both = known.join(linked, "sequence_hash", "full").join(primary.withColumn("_p", F.lit(True)), "sequence_hash", "full")
    gaps = both.agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_f").isNull()).alias("missing_sequences"),
        F.count_if(F.col("_f").isNotNull() & F.col("_r").isNull()).alias("sequences_without_relationship"),
        F.count_if(F.col("_r").isNotNull() & F.col("_f").isNull()).alias("relationships_without_sequence"),
    )
    own = final.agg(
        F.count(F.lit(1)).alias("sequence_rows"),
        (F.count(F.lit(1)) == F.count_distinct("sequence_hash")).alias("sequence_hash_unique"),
        (F.count_distinct("sequence_hash", "amino_acid_sequence") - F.count_distinct("sequence_hash")).alias("hash_conflicts"),
        F.count_if(F.col("protein_length") != F.length("amino_acid_sequence")).alias("length_mismatches"),
        F.count_if(F.col("amino_acid_sequence").contains("*")).alias("sequences_with_stop"),
    )
    chosen = F.col("eligibility") == "primary"
    rows = final_map.agg(
        F.count(F.lit(1)).alias("mapping_rows"),
        F.count_if(chosen & (F.coalesce("resolved_symbol", F.lit("")) == "")).alias("primary_without_symbol"),
        F.count_if(chosen & ~F.col("sequence_hash_in_final")).alias("primary_rows_without_sequence"),
    )
    return _one_row(own, gaps, rows, relations.agg(F.count(F.lit(1)).alias("relationship_rows")))


def coverage(vocabulary: DataFrame, summary: DataFrame) -> DataFrame:
    """One row: names, rows of the summary, its distinct names, and names that it lacks."""
    names = vocabulary.select("vcc_gene_name").distinct()
    gaps = names.join(summary.select("vcc_gene_name").distinct(), "vcc_gene_name", "left_anti")
    return _one_row(
        names.agg(F.count(F.lit(1)).alias("names")),
        summary.agg(F.count(F.lit(1)).alias("summary_rows"), F.count_distinct("vcc_gene_name").alias("summary_names")),
        gaps.agg(F.count(F.lit(1)).alias("names_without_summary")),
    )


def orphan_hashes(final: DataFrame, relations: DataFrame) -> DataFrame:
    """Hashes that only one of the two tables has, and which one."""
    left = checks.orphans(final, relations, "sequence_hash").withColumn("only_in", F.lit("sequences"))
    return left.unionByName(checks.orphans(relations, final, "sequence_hash").withColumn("only_in", F.lit("relationships")))


def unexpected_loci(final_map: DataFrame) -> DataFrame:
    """Rows and sequences of the final selection that stand on neither a primary locus nor an exception, by class of locus."""
    odd = final_map.filter(F.col("selected_for_primary_esm") & ~F.col("is_primary_locus") & ~F.col("is_patch_exception"))
    return odd.groupBy("locus_class").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("protein_sequence_hash").alias("sequences"))


def selected_loci(final_map: DataFrame) -> DataFrame:
    """Rows and sequences of the final selection by class of locus."""
    chosen = final_map.filter("selected_for_primary_esm")
    return chosen.groupBy("locus_class").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("protein_sequence_hash").alias("sequences"))


def isoforms_per_gene(vocabulary: DataFrame, relations: DataFrame) -> DataFrame:
    """Distinct sequences of every name, zero for those without."""
    n = relations.groupBy("vcc_gene_name").agg(F.count_distinct("sequence_hash").alias("isoforms"))
    return vocabulary.select("vcc_gene_name").distinct().join(n, "vcc_gene_name", "left").fillna(0, ["isoforms"])


def shared_sequences(relations: DataFrame) -> DataFrame:
    """Sequences of more than one name."""
    per = relations.groupBy("sequence_hash").agg(F.count_distinct("vcc_gene_name").alias("gene_count"), _set("vcc_gene_name").alias("genes"))
    return per.filter(F.col("gene_count") > 1)


def biotypes(final_map: DataFrame, by: str) -> DataFrame:
    """Rows and distinct sequences of each transcript type, and rows by another column's values.

    Raises for more than MOST_KINDS values, as each becomes a column.
    """
    kinds = [r[0] for r in final_map.select(by).distinct().orderBy(by).limit(MOST_KINDS + 1).collect()]
    if len(kinds) > MOST_KINDS:
        raise ValueError(f"{by} has more than {MOST_KINDS} values")
    sums = final_map.groupBy("transcript_type").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("protein_sequence_hash").alias("sequences"))
    cross = final_map.groupBy("transcript_type").pivot(by, kinds).count()
    return sums.join(cross, "transcript_type", "left").fillna(0)


def stops(refined: DataFrame, sequences: DataFrame) -> DataFrame:
    """Sequences with a stop: class, 1-based places, and the names that have them."""
    held = refined.filter("sequence_has_stop").groupBy("protein_sequence_hash").agg(F.min("star_class").alias("star_class"), _set("vcc_gene_name").alias("genes"))
    return held.join(sequences.distinct(), "protein_sequence_hash").withColumn("stop_positions", C.stop_positions(F.col("amino_acid_sequence"))).drop("amino_acid_sequence")


def targets_review(targets: DataFrame, resolution: DataFrame, final_map: DataFrame) -> DataFrame:
    """How each target resolved and what it has."""
    n = final_map.filter("selected_for_primary_esm").groupBy("vcc_gene_name").agg(F.count_distinct("protein_sequence_hash").alias("primary_sequences"))
    rows = targets.select("target_gene").distinct().join(resolution, F.col("target_gene") == F.col("vcc_gene_name"), "left")
    rows = rows.join(n, "vcc_gene_name", "left").fillna(0, ["primary_sequences"]).fillna("", ["resolved_symbol", "method", "resolution_status"])
    review = (F.col("resolved_symbol") == "") | (F.col("primary_sequences") == 0)
    return rows.select("target_gene", "resolved_symbol", "method", "resolution_status", "primary_sequences", review.alias("review_flag"))


def unresolved_names(resolution: DataFrame) -> DataFrame:
    """Names without a resolution: their class, relevance and where evidence may be sought."""
    rows = resolution.filter(F.col("resolution_status") == "unresolved").withColumn("identifier_class", C.identifier_class(F.col("vcc_gene_name")))
    kind = F.col("identifier_class")
    return rows.select(
        "vcc_gene_name",
        "identifier_class",
        F.when(kind.isin("noncoding_like", "pseudogene_like"), "low").otherwise("unknown").alias("relevance"),
        F.when(kind == "accession_like", "accession_review").otherwise("manual_review").alias("evidence_source"),
        F.when(F.col("method") == "unresolved", "no_exact_evidence").otherwise(F.col("method")).alias("reason"),
    )


def length_bins(final: DataFrame, relations: DataFrame) -> DataFrame:
    """Every length bin with its sequences and the distinct names they belong to."""
    binned = final.select("sequence_hash", C.length_bin(F.col("protein_length")).alias("bin"))
    sums = binned.join(relations.select("sequence_hash", "vcc_gene_name"), "sequence_hash", "left").groupBy("bin").agg(
        F.count_distinct("sequence_hash").alias("sequences"), F.count_distinct("vcc_gene_name").alias("genes")
    )
    bins = final.sparkSession.range(len(C.LENGTH_BINS)).select(F.col("id").cast("int").alias("bin"))
    return bins.join(sums, "bin", "left").fillna(0).withColumn("label", C.bin_label(F.col("bin")))
