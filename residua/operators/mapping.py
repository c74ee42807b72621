"""From a vocabulary of gene names to transcripts and sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.session import shuffle_partitions

# Statuses that call for a review, and kinds of names with several genes.
REVIEWED = ("ambiguous_multiple_gene_ids", "requires_policy_review", "translated_sequence_invalid")
SEVERAL_GENES = ("patch_or_alternate_locus", "true_ambiguous_symbol_or_other")

#: Regions that make a name with several gene ids a matter of patches or alternate loci.
ALTERNATE_REGION = "^(KI|GL|JH|HSCHR|NW_|NT_)"

MAPPING_COLUMNS = (
    "vcc_gene_name gene_id gene_id_stable genomic_region gene_name_gencode gene_type transcript_id transcript_id_stable "
    "transcript_name transcript_type protein_id protein_id_stable protein_sequence_hash protein_length is_mane_select "
    "is_mane_plus_clinical mane_status refseq_transcript_id refseq_protein_id is_perturbation_target sequence_valid "
    "include_for_esm exclusion_reason mapping_status review_flag"
).split()


def match_genes(vocabulary: DataFrame, genes: DataFrame) -> DataFrame:
    """vcc_gene_name and the gene_id of each gene of exactly that name; names without one have a null."""
    named = genes.filter(F.col("gene_name") != "").select(F.col("gene_name").alias("vcc_gene_name"), "gene_id", F.col("gene_type").alias("_gene_type"))
    return vocabulary.select("vcc_gene_name").join(named, "vcc_gene_name", "left")


def find_proteins(transcripts: DataFrame, index: DataFrame) -> DataFrame:
    """transcripts with `protein`, the record under the exact protein id, or else under the stable one.

    index is annotation.protein_index's, or the records themselves, which are then shuffled once and not once for each look-up.
    """
    if "key" not in index.columns:
        return _find_records(transcripts, index)
    record = F.struct(*[c for c in index.columns if c != "key"])
    found = transcripts
    for id_, name in (("protein_id", "_exact"), ("protein_id_stable", "_stable")):
        # Rows without an id find nothing, but would all be sent to one task; a number of their own spreads them.
        spread = F.when(F.col(id_).isNull(), F.xxhash64(*transcripts.columns)).otherwise(F.lit(0))
        keyed = index.select(F.col("key").alias(id_), F.lit(0).cast("long").alias("_spread"), record.alias(name))
        found = found.withColumn("_spread", spread).join(keyed, [id_, "_spread"], "left").drop("_spread")
    return found.withColumn("protein", F.coalesce("_exact", "_stable")).drop("_exact", "_stable")


def _find_records(transcripts: DataFrame, records: DataFrame) -> DataFrame:
    """find_proteins over records. What an id may find, exactly or not, has its stable id, so both look-ups go by that."""
    n = shuffle_partitions(records.sparkSession)
    kept = [c for c in records.columns if c not in ("protein_id", "protein_id_stable", "record_no")]
    id_, stable = F.col("protein_id"), F.col("protein_id_stable")
    # Both filters stand here, as one that only a join infers would keep the two groupings from reading one shuffle.
    held = records.filter(id_.isNotNull() & stable.isNotNull()).repartition(n, "protein_id_stable")
    row, no = F.struct(*kept), F.col("record_no")
    last = held.groupBy(stable.alias("_by_last"), id_.alias("_id")).agg(F.max_by(row, no).alias("_exact"))
    first = held.groupBy(stable.alias("_by_first")).agg(F.coalesce(F.max_by(row, F.when(id_ == stable, no)), F.min_by(row, no)).alias("_stable"))
    # Rows without an id find nothing, but would all be sent to one task; a number of their own spreads them.
    own = F.xxhash64(*[c for c in transcripts.columns if c != "line_no"]).cast("string")
    rows = transcripts.withColumn("_by", F.coalesce(stable, own)).repartition(n, "_by")
    # Not by equality: as a second key of the join, it would have both sides shuffled again.
    same = (F.col("_by") == F.col("_by_last")) & (id_ <= F.col("_id")) & (id_ >= F.col("_id"))
    found = rows.join(last, same, "left").join(first, F.col("_by") == F.col("_by_first"), "left")
    protein = F.when(stable.isNotNull(), F.coalesce("_exact", "_stable"))
    return found.withColumn("protein", protein).drop("_by", "_by_last", "_by_first", "_id", "_exact", "_stable")


def build_rows(
    vocabulary: DataFrame, targets: DataFrame, genes: DataFrame, transcripts: DataFrame, proteins: DataFrame, mane: DataFrame
) -> DataFrame:
    """One row a vocabulary name and transcript, plus the matched record's sequence columns under `protein`."""
    matched = match_genes(vocabulary, genes).filter(F.col("gene_id").isNotNull()).drop("_gene_type")
    aim = targets.select(F.col("target_gene").alias("vcc_gene_name"), F.lit(True).alias("_target")).distinct()
    matched = matched.join(aim, "vcc_gene_name", "left")  # names are few; transcripts that no name asks for go before the other joins
    # Proteins come last, so that their hashes aren't shuffled again.
    rows = find_proteins(transcripts.join(matched, "gene_id").join(mane, "transcript_id_stable", "left"), proteins)
    found = F.col("protein").isNotNull()
    valid = F.coalesce(F.col("protein.sequence_valid"), F.lit(False))
    reason = C.eligibility(F.col("protein_id"), found, valid, F.col("protein.sequence_issue"), F.col("transcript_type"))
    rows = rows.withColumn("exclusion_reason", reason)
    blank = F.lit("")
    include = F.col("exclusion_reason") == ""
    status = F.when(include, "mapped_with_esm_candidate").otherwise(F.col("exclusion_reason"))
    return rows.select(
        "vcc_gene_name",
        "gene_id",
        "gene_id_stable",
        F.col("seqname").alias("genomic_region"),
        F.col("gene_name").alias("gene_name_gencode"),
        "gene_type",
        "transcript_id",
        "transcript_id_stable",
        "transcript_name",
        "transcript_type",
        "protein_id",
        "protein_id_stable",
        F.col("protein.protein_sequence_hash").alias("protein_sequence_hash"),
        F.col("protein.protein_length").alias("protein_length"),
        F.coalesce("is_mane_select", F.lit(False)).alias("is_mane_select"),
        F.coalesce("is_mane_plus_clinical", F.lit(False)).alias("is_mane_plus_clinical"),
        F.coalesce("mane_status", blank).alias("mane_status"),
        F.coalesce("refseq_transcript_id", blank).alias("refseq_transcript_id"),
        F.coalesce("refseq_protein_id", blank).alias("refseq_protein_id"),
        F.col("_target").isNotNull().alias("is_perturbation_target"),
        (found & valid).alias("sequence_valid"),
        include.alias("include_for_esm"),
        "exclusion_reason",
        status.alias("mapping_status"),
        (~F.col("exclusion_reason").isin("", "no_translation")).alias("review_flag"),
        "protein",
    )


def mapping_table(rows: DataFrame) -> DataFrame:
    return rows.select(*MAPPING_COLUMNS)


def sequence_table(rows: DataFrame) -> DataFrame:
    """One row a sequence hash, included if any of its transcripts is. Raises when read if a hash has two strings."""
    held = rows.filter(F.col("protein").isNotNull()).select("protein.*", "include_for_esm")
    one = held.groupBy("protein_sequence_hash").agg(
        F.min("amino_acid_sequence").alias("amino_acid_sequence"),
        F.max("amino_acid_sequence").alias("_other"),
        F.min("protein_length").alias("protein_length"),
        F.min("sequence_valid").alias("sequence_valid"),
        F.bool_or("include_for_esm").alias("include_for_esm"),
        F.min("sequence_issue").alias("sequence_issue"),
    )
    checked = F.when(F.col("_other") == F.col("amino_acid_sequence"), F.col("amino_acid_sequence")).otherwise(
        F.raise_error(F.concat(F.lit("two sequences under hash "), F.col("protein_sequence_hash")))
    )
    return one.withColumn("amino_acid_sequence", checked).drop("_other")


def sequences_of(table: DataFrame, records: DataFrame) -> DataFrame:
    """As sequence_table, from the mapping table and the records, so that texts are shuffled once a hash and task."""
    used = table.filter(F.col("protein_sequence_hash").isNotNull()).groupBy("protein_sequence_hash").agg(F.bool_or("include_for_esm").alias("include_for_esm"))
    held = records.drop("protein_id", "protein_id_stable", "record_no").distinct().join(used, "protein_sequence_hash")
    return sequence_table(held.withColumn("protein", F.struct(*[c for c in held.columns if c != "include_for_esm"])))


def gene_summary(vocabulary: DataFrame, targets: DataFrame, genes: DataFrame, rows: DataFrame) -> DataFrame:
    """Exactly one row a vocabulary name, with its counts and mapping status."""
    ids = match_genes(vocabulary, genes).groupBy("vcc_gene_name").agg(
        F.count_distinct("gene_id").alias("num_gencode_gene_ids"),
        F.coalesce(F.bool_or(F.col("_gene_type") == "protein_coding"), F.lit(False)).alias("protein_coding_gene"),
    )
    reason, include = F.col("exclusion_reason"), F.col("include_for_esm")
    sums = rows.groupBy("vcc_gene_name").agg(
        F.count(F.lit(1)).alias("num_transcripts"),
        F.count("protein_sequence_hash").alias("num_translated_transcripts"),
        F.count_distinct(F.when(include, F.col("protein_sequence_hash"))).alias("num_unique_protein_sequences"),
        F.count_if(include).alias("num_esm_candidate_sequences"),
        F.bool_or("is_mane_select").alias("mane_select_available"),
        F.bool_or(reason.startswith("requires_policy_review")).alias("_review"),
        F.bool_or(~reason.isin("", "no_translation", "sequence_not_in_fasta")).alias("_invalid"),
        F.bool_or(F.col("genomic_region").rlike(ALTERNATE_REGION)).alias("_alternate"),
    )
    aim = targets.select(F.col("target_gene").alias("vcc_gene_name"), F.lit(True).alias("is_perturbation_target")).distinct()
    all_ = vocabulary.select("vcc_gene_name").distinct().join(ids, "vcc_gene_name", "left").join(sums, "vcc_gene_name", "left").join(aim, "vcc_gene_name", "left")
    numbers = ["num_gencode_gene_ids", "num_transcripts", "num_translated_transcripts", "num_unique_protein_sequences", "num_esm_candidate_sequences"]
    flags = ["protein_coding_gene", "mane_select_available", "_review", "_invalid", "_alternate", "is_perturbation_target"]
    all_ = all_.fillna(0, numbers).fillna(False, flags)
    n, candidates = F.col("num_gencode_gene_ids"), F.col("num_esm_candidate_sequences")
    unusable = F.col("_invalid") & (F.col("num_translated_transcripts") > 0)
    # The statuses of a name and the reasons for them. The first that holds counts.
    statuses = [
        (n > 1, "ambiguous_multiple_gene_ids", "multiple_gencode_gene_ids"),
        (n == 0, "gene_symbol_not_found", "no_exact_gencode_gene_name_match"),
        (candidates > 0, "mapped_with_esm_candidate", ""),
        (~F.col("protein_coding_gene"), "non_protein_coding", "no_protein_coding_gene_or_transcript"),
        (F.col("_review"), "requires_policy_review", "translated_special_transcript_biotype"),
        (unusable, "translated_sequence_invalid", "translated_record_invalid_or_unusable"),
        (F.lit(True), "mapped_no_eligible_protein", "protein_coding_gene_without_eligible_translation"),
    ]
    found = F.coalesce(*[F.when(c, F.struct(F.lit(s).alias("s"), F.lit(r).alias("r"))) for c, s, r in statuses])
    kind = F.when(n > 1, F.when(F.col("_alternate"), SEVERAL_GENES[0]).otherwise(SEVERAL_GENES[1])).otherwise("")
    return all_.withColumn("_found", found).select(
        "vcc_gene_name",
        "is_perturbation_target",
        F.col("_found.s").alias("mapping_status"),
        *numbers,
        "protein_coding_gene",
        "mane_select_available",
        (n > 1).alias("multi_gene_id_flag"),
        (F.col("num_unique_protein_sequences") > 1).alias("multiple_isoforms"),
        (candidates > 0).alias("esm_candidate_available"),
        F.col("_found.s").isin(*REVIEWED).alias("review_flag"),
        F.col("_found.r").alias("review_reason"),
        kind.alias("multi_gene_id_classification"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
