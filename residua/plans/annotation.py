"""The whole way from annotation files to final tables, stage by stage, each written before the next reads it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.operators import audit, checks, mapping, refine, resolution
from residua.session import staged
from residua.sources import annotation as sources
from residua.sources import sinks


@dataclass(frozen=True)
class Inputs:
    """Paths of the files, and the names that go into the final tables."""

    vocabulary: str
    targets: str
    gtf: str
    fasta: str
    mane: str
    complete: str
    withdrawn: str
    source: str = ""
    release: str = ""


def _first_column(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(f"`{df.columns[0]}`").alias(name)).filter(F.col(name) != "").distinct()


class Tables:
    """The tables of a run, each made and published under `out` when it is first asked for, after those it is made of.

    The vocabulary must be unique and hold all targets; expected adds further checks of it. What fails a
    check raises before a table that rests on it is published.
    """

    NAMES = (
        "genes transcripts protein_records mane gene_protein_mapping protein_sequences gene_mapping_summary gene_resolution "
        "gene_protein_mapping_refined sequences_final gene_protein_mapping_final relationships_final gene_mapping_summary_final"
    ).split()

    def __init__(self, spark: SparkSession, files: Inputs, out: str, expected: checks.Expectations | None = None):
        self.spark, self.files, self.out, self.expected = spark, files, out, expected
        self.made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            return getattr(self, name)
        if name not in self.made:
            df = getattr(self, f"_{name}")()
            sinks.write_atomic(df, f"{self.out}/{name}")
            self.made[name] = self.spark.read.schema(df.schema).parquet(f"{self.out}/{name}")
        return self.made[name]

    @cached_property
    def vocabulary(self) -> DataFrame:
        raw = sources.read_delimited(self.spark, self.files.vocabulary)
        listed = raw.select(F.col(f"`{raw.columns[0]}`").alias("vcc_gene_name"))
        checks.enforce((self.expected or checks.Expectations(unique=("vcc_gene_name",))).evaluate(listed))
        names = _first_column(raw, "vcc_gene_name")
        stray = checks.orphans(self.targets.withColumnRenamed("target_gene", "vcc_gene_name"), names, "vcc_gene_name")
        if not stray.isEmpty():
            raise ValueError("a target is not in the vocabulary")
        return names

    @cached_property
    def targets(self) -> DataFrame:
        return sources.read_delimited(self.spark, self.files.targets).select("target_gene").distinct()

    @cached_property
    def gtf(self) -> DataFrame:
        return sources.read_gtf(self.spark, self.files.gtf)

    @cached_property
    def fasta(self) -> DataFrame:
        return sources.read_fasta(self.spark, self.files.fasta)

    @cached_property
    def complete(self) -> DataFrame:
        return sources.read_delimited(self.spark, self.files.complete, "\t")

    @cached_property
    def tokens(self) -> DataFrame:
        return sources.hgnc_tokens(self.complete, sources.read_delimited(self.spark, self.files.withdrawn, "\t"))

    @cached_property
    def proteins(self) -> DataFrame:
        """The index of the records without their texts, which are looked up by hash; written, as several joins read it."""
        return staged(sources.protein_index(self["protein_records"].drop("amino_acid_sequence")).drop("record_no"), "proteins")

    @cached_property
    def sequences(self) -> DataFrame:
        return self["protein_records"].select("protein_sequence_hash", "amino_acid_sequence").distinct()

    @cached_property
    def stopped(self) -> DataFrame:
        """The texts with a stop; written, so that a join knows how few they are and needn't shuffle the rows."""
        return staged(self["protein_records"].filter(F.contains("amino_acid_sequence", F.lit("*"))).select("protein_sequence_hash", "amino_acid_sequence").distinct(), "stopped")

    def _genes(self) -> DataFrame:
        return sources.gtf_genes(self.gtf)

    def _transcripts(self) -> DataFrame:
        return sources.gtf_transcripts(self.gtf)

    def _protein_records(self) -> DataFrame:
        return sources.protein_records(self.fasta)

    def _mane(self) -> DataFrame:
        return sources.read_mane(self.spark, self.files.mane)

    def _rows(self, vocabulary: DataFrame) -> DataFrame:
        rows = mapping.build_rows(vocabulary, self.targets, self["genes"], self["transcripts"], self["protein_records"].drop("amino_acid_sequence"), self["mane"])
        return mapping.mapping_table(rows)

    def _gene_protein_mapping(self) -> DataFrame:
        return self._rows(self.vocabulary)

    def _protein_sequences(self) -> DataFrame:
        return mapping.sequences_of(self["gene_protein_mapping"], self["protein_records"])

    def _gene_mapping_summary(self) -> DataFrame:
        return mapping.gene_summary(self.vocabulary, self.targets, self["genes"], self["gene_protein_mapping"])

    def _gene_resolution(self) -> DataFrame:
        return resolution.resolve(self.vocabulary, self.tokens, self.complete, self["genes"].select("gene_name"))

    def _gene_protein_mapping_refined(self) -> DataFrame:
        resolved = self["gene_resolution"]
        symbols = resolved.filter("alias_rescued").select(F.col("resolved_symbol").alias("vcc_gene_name")).distinct()
        have = self["gene_protein_mapping"].select(F.col("gene_name_gencode").alias("vcc_gene_name")).distinct()
        symbols = symbols.join(have, "vcc_gene_name", "left_anti")  # rescue() takes rows of no others
        rows = resolution.rescue(self["gene_protein_mapping"], resolved, staged(self._rows(symbols), "rescued"))
        return refine.classify(rows, resolved, self.stopped)

    def _sequences_final(self) -> DataFrame:
        return refine.final_sequences(self["gene_protein_mapping_refined"], self.sequences, self.files.source, self.files.release)

    def _gene_protein_mapping_final(self) -> DataFrame:
        return refine.final_mapping(self["gene_protein_mapping_refined"], self["sequences_final"])

    def _relationships_final(self) -> DataFrame:
        return refine.relationships(self["gene_protein_mapping_final"])

    def _gene_mapping_summary_final(self) -> DataFrame:
        return refine.final_summary(self.vocabulary, self.targets, self["gene_resolution"], self.complete, self["gene_protein_mapping_final"])


def run(spark: SparkSession, files: Inputs, out: str, expected: checks.Expectations | None = None) -> dict[str, DataFrame]:
    """Build every table under `out` and return them by name, read back; then the reports on them."""
    made = Tables(spark, files, out, expected)
    vocabulary, targets, tokens, sequences = made.vocabulary, made.targets, made.tokens, made.sequences
    tables = {name: made[name] for name in Tables.NAMES}
    refined, final_map, final = tables["gene_protein_mapping_refined"], tables["gene_protein_mapping_final"], tables["sequences_final"]
    relations, resolved, summary = tables["relationships_final"], tables["gene_resolution"], tables["gene_mapping_summary_final"]
    checks.enforce(checks.Expectations(unique=("vcc_gene_name",)).evaluate(summary))
    core = audit.integrity(final_map, final, relations).first().asDict() | audit.coverage(vocabulary, summary).first().asDict()
    core["unexpected_primary_loci"] = {r.locus_class: r["rows"] for r in audit.unexpected_loci(final_map).collect()}
    orphans = audit.orphan_hashes(final, relations)
    core["orphan_hashes"] = orphans.count()
    sinks.write_text(spark, checks.to_json(core), f"{out}/mapping_final_qc.json")
    reports = {
        "orphan_hashes": orphans,
        "isoforms_per_gene": audit.isoforms_per_gene(vocabulary, relations),
        "shared_sequences": audit.shared_sequences(relations),
        "transcript_biotypes": audit.biotypes(final_map, "eligibility"),
        "stop_sequences": audit.stops(refined, sequences),
        "targets_review": audit.targets_review(targets, resolved, final_map),
        "unresolved_names": audit.unresolved_names(resolved),
        "length_bins": audit.length_bins(final, relations),
        "ambiguous_candidates": resolution.ambiguous_candidates(resolved, tokens),
    }
    for name, report in reports.items():
        sinks.write_csv(report, f"{out}/audit/{name}")
    return tables
