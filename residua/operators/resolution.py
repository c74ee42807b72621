"""Resolving names by precedence of evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.sources.annotation import in_file_order

RESCUED = ("previous_symbol", "alias_symbol", "withdrawn_or_merged_symbol", "stable_ensembl_id")


def resolve(vocabulary: DataFrame, tokens: DataFrame, complete: DataFrame, exact_symbols: DataFrame) -> DataFrame:
    """One row a name: resolved_symbol, hgnc_id, method, evidence, status, alias_rescued, resolution_status.

    A stable id of a gene decides at once. Otherwise the candidates are the names of genes, approved ones
    alone if there are any; one gene among them wins, by its first candidate, several are ambiguous. A
    withdrawn name resolves to what it was merged into. Names without evidence that are an exact symbol
    (gene_name) count as such; the rest keep themselves as symbol and are `unresolved` by method.
    """
    names = vocabulary.select("vcc_gene_name").distinct()
    by_id = in_file_order(complete, "n").filter(F.coalesce("ensembl_gene_id", F.lit("")) != "")
    by_id = by_id.groupBy(C.stable_id(F.col("ensembl_gene_id")).alias("_id")).agg(F.max_by(F.struct("symbol", "hgnc_id", "status"), "n").alias("stable"))
    candidate = F.struct("ord", "method", "hgnc_id", "symbol", "status", "merged_into")
    approved = F.col("method") == "approved_symbol"
    found = tokens.groupBy(F.col("token").alias("_token")).agg(
        F.min(F.when(approved, candidate)).alias("a"),
        F.count_distinct(F.when(approved, F.col("hgnc_id"))).alias("n_a"),
        F.min(candidate).alias("c"),
        F.count_distinct("hgnc_id").alias("n_c"),
    )
    found = found.select(
        "_token", F.coalesce("a", "c").alias("best"), F.when(F.col("n_a") > 0, F.col("n_a")).otherwise(F.col("n_c")).alias("genes")
    )
    exact = exact_symbols.select(F.col("gene_name").alias("_exact")).distinct()
    rows = names.join(by_id, C.stable_id(F.col("vcc_gene_name")) == F.col("_id"), "left")
    rows = rows.join(found, F.trim("vcc_gene_name") == F.col("_token"), "left").join(exact, F.col("vcc_gene_name") == F.col("_exact"), "left")
    merged = F.split("best.merged_into", r"\|")
    withdrawn = F.col("best.method") == "withdrawn_or_merged_symbol"
    into = F.struct(
        F.coalesce(F.trim(F.get(merged, F.lit(1))), F.lit("")).alias("resolved_symbol"),
        F.coalesce(F.trim(F.get(merged, F.lit(0))), F.lit("")).alias("hgnc_id"),
    )

    def case(symbol, hgnc, method, evidence, status):
        return F.struct(symbol.alias("resolved_symbol"), hgnc.alias("hgnc_id"), method.alias("method"), evidence.alias("evidence"), status.alias("status"))

    none, name = F.lit(""), F.col("vcc_gene_name")
    answer = (
        F.when(
            F.col("stable").isNotNull(),
            case(F.col("stable.symbol"), F.col("stable.hgnc_id"), F.lit("stable_ensembl_id"), F.lit("exact stable id"), F.col("stable.status")),
        )
        .when(F.col("genes") > 1, case(none, none, F.lit("ambiguous_hgnc_token"), F.lit("several genes under one name"), none))
        .when(withdrawn, case(into["resolved_symbol"], into["hgnc_id"], F.col("best.method"), F.lit("withdrawn entry"), F.col("best.status")))
        .when(
            F.col("best").isNotNull(), case(F.col("best.symbol"), F.col("best.hgnc_id"), F.col("best.method"), F.lit("exact name"), F.col("best.status"))
        )
        .when(F.col("_exact").isNotNull(), case(name, none, F.lit("exact_gencode_symbol"), F.lit("exact annotation symbol"), none))
        .otherwise(case(name, none, F.lit("unresolved"), none, none))
    )
    # A generator keeps the answer in one piece; merged with what reads it, it would be worked out again for each field.
    rows = rows.select("vcc_gene_name", F.inline(F.array(answer)))
    return rows.select(
        "*",
        F.col("method").isin(*RESCUED).alias("alias_rescued"),
        F.when(F.col("method").isin("unresolved", "ambiguous_hgnc_token") | (F.col("resolved_symbol") == ""), "unresolved").otherwise("resolved").alias("resolution_status"),
    )


def rescue(mapping: DataFrame, resolution: DataFrame, extra_rows: DataFrame) -> DataFrame:
    """mapping and the rows of rescued symbols that it lacks.

    extra_rows: mapping rows built with the resolved symbols as vocabulary. Every name that resolves to
    a symbol gets its rows.
    """
    have = mapping.select(F.col("gene_name_gencode").alias("_symbol")).distinct()
    wanted = resolution.filter("alias_rescued").select(F.col("resolved_symbol").alias("_symbol"), F.col("vcc_gene_name").alias("_name"))
    wanted = wanted.join(have, "_symbol", "left_anti")
    rows = extra_rows.join(wanted, F.col("vcc_gene_name") == F.col("_symbol")).withColumn("vcc_gene_name", F.col("_name")).drop("_symbol", "_name")
    return mapping.unionByName(rows.select(*mapping.columns))


def ambiguous_candidates(resolution: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each ambiguous name with every gene that bears it, once."""
    names = resolution.filter(F.col("method") == "ambiguous_hgnc_token").select(F.col("vcc_gene_name").alias("token"))
    return tokens.join(names, "token", "left_semi").select("token", "hgnc_id", "symbol", "method").dropDuplicates(["token", "hgnc_id"])
