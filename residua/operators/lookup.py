"""Looking up vectors by gene: never zeros for what is missing, and three ways to miss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.operators.vectors import gene_mean_var

UNKNOWN, NO_SEQUENCE, NOT_EXTRACTED, FOUND = "unknown_gene", "no_eligible_sequence", "not_extracted", "found"


class VectorLookup:
    """Genes (vcc_gene_name of summary) to isoforms (relations) to vectors (bank)."""

    def __init__(self, summary: DataFrame, relations: DataFrame, bank: DataFrame, feature: str = "mean"):
        self.summary, self.relations, self.bank, self.feature = summary, relations, bank.filter(F.col("status") == "ok"), feature

    def states(self) -> DataFrame:
        """state of every gene, with its isoforms and how many of them have vectors."""
        linked = self.relations.select("vcc_gene_name", "sequence_hash").distinct()
        have = self.bank.select("sequence_hash", F.lit(1).alias("_v"))
        n = linked.join(have, "sequence_hash", "left").groupBy("vcc_gene_name").agg(F.count(F.lit(1)).alias("isoforms"), F.count("_v").alias("extracted"))
        rows = self.summary.select("vcc_gene_name").distinct().join(n, "vcc_gene_name", "left").fillna(0, ["isoforms", "extracted"])
        state = F.when(F.col("isoforms") == 0, NO_SEQUENCE).when(F.col("extracted") == 0, NOT_EXTRACTED).otherwise(FOUND)
        return rows.withColumn("state", state)

    def state(self, gene: str) -> str:
        row = self.states().filter(F.col("vcc_gene_name") == gene).first()
        return row.state if row else UNKNOWN

    def has_vector(self, gene: str) -> bool:
        return self.state(gene) == FOUND

    def isoforms(self, gene: str) -> DataFrame:
        return self.relations.filter(F.col("vcc_gene_name") == gene).distinct()

    def isoform_vector(self, sequence_hash: str) -> list[float] | None:
        row = self.bank.filter(F.col("sequence_hash") == sequence_hash).select(self.feature).first()
        return row[0] if row else None

    def canonical_vector(self, gene: str) -> list[float] | None:
        """The vector of the MANE Select isoform; None without one: no other takes its place."""
        chosen = self.isoforms(gene).filter(F.col("mane_status").contains("MANE Select")).select("sequence_hash").distinct()
        row = self.bank.join(chosen, "sequence_hash", "left_semi").orderBy("sequence_hash").select(self.feature).first()
        return row[0] if row else None

    def gene_vectors(self) -> DataFrame:
        """Mean and variance over the isoforms of each gene that has any."""
        linked = self.relations.select("vcc_gene_name", "sequence_hash").distinct()
        return gene_mean_var(linked.join(self.bank, "sequence_hash").select("vcc_gene_name", F.col(self.feature).alias("state")), ["vcc_gene_name"])

    def gene_vector(self, gene: str) -> list[float] | None:
        row = self.gene_vectors().filter(F.col("vcc_gene_name") == gene).first()
        return row["mean"] if row else None

    def diversity(self) -> DataFrame:
        """Mean squared distance of a gene's isoforms from its MANE Select isoform; null without one."""
        from residua.functions import columns as C

        linked = self.relations.join(self.bank, "sequence_hash").select("vcc_gene_name", "sequence_hash", "mane_status", F.col(self.feature).alias("v")).distinct()
        anchor = linked.filter(F.col("mane_status").contains("MANE Select")).groupBy("vcc_gene_name").agg(F.min_by("v", "sequence_hash").alias("anchor"))
        return linked.join(anchor, "vcc_gene_name", "left").groupBy("vcc_gene_name").agg(F.avg(F.pow(C.l2_distance(F.col("v"), F.col("anchor")), 2)).alias("diversity"))
