"""Comparing products with the records of external databases: links, evidence flags, and classes of conflict.

A record is linked to a product in three ways: it holds exactly the product's sequence, it names the product,
or it names an accession that the product is known by, today or by way of older accessions. Sequences are
compared by hash and never put in place of the product's own. A sequence that many products and records
share is a class: it is linked with each record once and holds the number of its products, not all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import staged, unstage

# Evidence flags and classes.
FLAGS = ("in_gencode", "in_ensembl", "mane_select", "mane_plus_clinical", "uniprot_reviewed", "uniprot_match", "refseq_match", "sequence_crossvalidated")
MATCH, WARNING, REVIEW, FAILURE = "match", "warning", "manual_review", "mapping_failure"


def current_accessions(history: DataFrame, most_rounds: int = 40) -> DataFrame:
    """accession, current, steps: where each accession that was replaced ends up, over any number of replacements.

    history: accession, replaced_by. Of several replacements the one that sorts first counts; an accession
    that leads into a ring has no current one. Every round doubles the replacements that are looked through.
    """
    first = history.filter(F.col("accession").isNotNull() & F.col("replaced_by").isNotNull()).groupBy("accession").agg(F.min("replaced_by").alias("current"))
    now = staged(first.withColumn("steps", F.lit(1).cast("long")), "accessions")
    for _ in range(most_rounds):
        onward = now.select(F.col("accession").alias("current"), F.col("current").alias("after"), F.col("steps").alias("more"))
        joined = now.join(onward.hint("merge"), "current", "left")
        after = joined.select("accession", F.coalesce("after", "current").alias("current"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("after").isNotNull().alias("moved"))
        after = staged(after, "accessions")
        unstage(now)
        now = after.drop("moved")
        if after.filter("moved").isEmpty():
            return now
        # Whoever is still on the way after as many steps as there are accessions goes round in a ring.
        n = now.agg(F.count(F.lit(1))).first()[0]
        if after.filter(F.col("moved") & (F.col("steps") <= n)).isEmpty():
            break
    else:
        raise RuntimeError("accessions did not settle")
    ends = now.select(F.col("accession").alias("current")).distinct()
    return now.join(ends.hint("merge"), "current", "left_anti").select("accession", "current", "steps")


def _version_free(accession):
    return F.regexp_replace(accession, r"\.[0-9]+$", "")


def links(products: DataFrame, accessions: DataFrame, records: DataFrame, history: DataFrame) -> DataFrame:
    """A row a product and record that names it, and a row a record whose sequence products have.

    product_id, sequence_hash, products, database, accession, link, reviewed, superseded, isoform, other_release,
    same. link is `product` or `accession`, the stronger if both, or `sequence`, for which product_id is null and
    products is the number of products with that sequence. products: product_id, sequence_hash, valid, release.
    accessions: product_id, accession. records: database, accession, product_id (or null), sequence_hash,
    reviewed, release. Versions of accessions don't count; -2 and the like are isoforms.
    """
    current = current_accessions(history)
    base = records.select(
        "database", "accession", F.col("product_id").alias("claimed"), F.col("sequence_hash").alias("hash"), F.coalesce("reviewed", F.lit(False)).alias("reviewed"), F.col("release").alias("of"),
        _version_free(F.regexp_replace("accession", r"-[0-9]+$", "")).alias("stem"), F.col("accession").rlike(r"-[0-9]+$").alias("isoform"),
    )
    base = base.join(current.select(F.col("accession").alias("stem"), "current"), "stem", "left")
    base = base.withColumn("superseded", F.col("current").isNotNull()).withColumn("name", F.coalesce("current", "stem")).drop("stem", "current")
    known = accessions.select("product_id", _version_free(F.col("accession")).alias("stem"))
    known = known.join(current.select(F.col("accession").alias("stem"), "current"), "stem", "left").select("product_id", F.coalesce("current", "stem").alias("name")).distinct()
    kept = ["database", "accession", "claimed", "hash", "reviewed", "of", "isoform", "superseded"]
    named = base.filter(F.col("claimed").isNotNull()).select(F.col("claimed").alias("product_id"), F.lit(1).alias("rank"), *kept)
    by_name = base.join(known, "name").select("product_id", F.lit(2).alias("rank"), *kept)
    every = named.unionByName(by_name).groupBy("product_id", *kept).agg(F.min("rank").alias("rank"))
    found = every.join(products.select("product_id", "sequence_hash", "release"), "product_id")
    found = found.select(
        "product_id", "sequence_hash", F.lit(1).cast("long").alias("products"), "database", "accession", F.when(F.col("rank") == 1, "product").otherwise("accession").alias("link"), "reviewed", "superseded", "isoform",
        (F.col("of").isNotNull() & F.col("release").isNotNull() & (F.col("of") != F.col("release"))).alias("other_release"), F.coalesce(F.col("hash") == F.col("sequence_hash"), F.lit(False)).alias("same"),
    )
    own = products.filter(F.col("sequence_hash").isNotNull()).groupBy("sequence_hash").agg(F.count(F.lit(1)).alias("products"))
    shared = base.withColumnRenamed("hash", "sequence_hash").join(own, "sequence_hash")
    shared = shared.select(
        F.lit(None).cast("string").alias("product_id"), "sequence_hash", "products", "database", "accession", F.lit("sequence").alias("link"), "reviewed", "superseded", "isoform", F.lit(False).alias("other_release"), F.lit(True).alias("same"),
    )
    return found.unionByName(shared)


def classified(linked: DataFrame) -> DataFrame:
    """linked with `class`: a differing record is a warning if its release, version or isoform explains it."""
    known = F.col("other_release") | F.col("superseded") | F.col("isoform")
    return linked.withColumn("class", F.when(F.col("same"), MATCH).when(known, WARNING).otherwise(REVIEW))


def evidence(products: DataFrame, linked: DataFrame) -> DataFrame:
    """A row a product: FLAGS, counts of its records by class, and `verdict`.

    products: product_id, sequence_hash, valid, is_mane_select, is_mane_plus_clinical. Matches are all records with
    the product's sequence, named or not. Without a valid sequence of its own a product is a mapping failure,
    whatever records say; else its worst record decides; without records it is `no_record`.
    """
    each = classified(linked)

    def some(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    of = {name: F.col("database") == name for name in ("ensembl", "uniprot", "refseq")}
    named, shared = F.col("link") != "sequence", F.col("link") == "sequence"
    by_product = each.filter(named).groupBy("product_id").agg(
        some(of["ensembl"]).alias("ensembl"), some(of["uniprot"] & F.col("reviewed")).alias("reviewed"),
        F.count_if(F.col("class") == WARNING).alias("warnings"), F.count_if(F.col("class") == REVIEW).alias("reviews"),
    )
    by_sequence = each.filter(shared).groupBy("sequence_hash").agg(
        some(of["ensembl"]).alias("ensembl_too"), some(of["uniprot"] & F.col("reviewed")).alias("reviewed_too"),
        some(of["uniprot"]).alias("uniprot_match"), some(of["refseq"]).alias("refseq_match"), F.count(F.lit(1)).alias("matches"),
    )
    out = products.select(
        "product_id", "sequence_hash", "valid", F.coalesce("is_mane_select", F.lit(False)).alias("mane_select"), F.coalesce("is_mane_plus_clinical", F.lit(False)).alias("mane_plus_clinical")
    )
    out = out.join(by_product, "product_id", "left").join(by_sequence, "sequence_hash", "left")
    flags = ["ensembl", "ensembl_too", "reviewed", "reviewed_too", "uniprot_match", "refseq_match"]
    out = out.fillna(False, flags).fillna(0, ["matches", "warnings", "reviews"])
    out = out.withColumn("in_ensembl", F.col("ensembl") | F.col("ensembl_too")).withColumn("uniprot_reviewed", F.col("reviewed") | F.col("reviewed_too"))
    out = out.withColumn("in_gencode", F.lit(True)).withColumn("sequence_crossvalidated", F.col("matches") > 0)
    verdict = F.when(~F.coalesce("valid", F.lit(False)), FAILURE).when(F.col("reviews") > 0, REVIEW).when(F.col("warnings") > 0, WARNING).when(F.col("matches") > 0, MATCH).otherwise("no_record")
    return out.select("product_id", *FLAGS, "matches", "warnings", "reviews", verdict.alias("verdict"))
