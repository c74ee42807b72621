"""Queries on products and external records, which are laid out from the keys of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from residua.operators import reconcile
from residua.plans.registry import query
from residua.session import table


def _inputs(spark, sf_dir):
    """Products, their accessions, records of three databases, and accessions that were replaced, once or three times."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("o"))
    products = o.selectExpr("'P' || o AS product_id", "sha2(CAST(o % 400 AS STRING), 256) AS sequence_hash", "o % 13 <> 0 AS valid", "'r1' AS release", "o % 12 = 0 AS is_mane_select", "o % 24 = 5 AS is_mane_plus_clinical")
    accessions = o.filter("o % 3 = 0").selectExpr("'P' || o AS product_id", "'NP_' || o || '.1' AS accession")
    changed = "sha2(IF(o % 5 = 0, 'x' || o, CAST(o % 400 AS STRING)), 256) AS sequence_hash"
    refseq = o.filter("o % 3 = 0").selectExpr("'refseq' AS database", "CASE o % 4 WHEN 0 THEN 'OLD3_' || o WHEN 1 THEN 'OLD1_' || o || '.4' ELSE 'NP_' || o || '.2' END AS accession", "CAST(NULL AS STRING) AS product_id", changed, "false AS reviewed", "'r1' AS release")
    uniprot = o.filter("o % 4 = 1").selectExpr("'uniprot' AS database", "'Q' || o || IF(o % 8 = 1, '-2', '') AS accession", "'P' || o AS product_id", changed, "o % 16 = 1 AS reviewed", "IF(o % 32 = 5, 'r0', 'r1') AS release")
    ensembl = o.filter("o % 2000 = 7").selectExpr("'ensembl' AS database", "'E' || o AS accession", "CAST(NULL AS STRING) AS product_id", "sha2(CAST(o % 400 AS STRING), 256) AS sequence_hash", "CAST(NULL AS BOOLEAN) AS reviewed", "CAST(NULL AS STRING) AS release")
    step = F.explode(F.array(*[F.struct(F.concat(F.lit(a), F.col("o")).alias("accession"), F.concat(F.lit(b), F.col("o")).alias("replaced_by")) for a, b in (("OLD3_", "OLD2_"), ("OLD2_", "OLD1_"), ("OLD1_", "NP_"))]))
    history = o.filter("o % 3 = 0").select(step.alias("x")).select("x.*")
    return products, accessions, refseq.unionByName(uniprot).unionByName(ensembl), history


_BASE = """WITH o AS (SELECT o_orderkey AS o FROM orders), own AS (SELECT o, sha256(CAST(o % 400 AS VARCHAR)) AS h FROM o),
record AS (
  SELECT 'refseq' AS database, CASE o % 4 WHEN 0 THEN 'OLD3_' || o WHEN 1 THEN 'OLD1_' || o || '.4' ELSE 'NP_' || o || '.2' END AS accession, o, 2 AS direct,
    sha256(CASE WHEN o % 5 = 0 THEN 'x' || o ELSE CAST(o % 400 AS VARCHAR) END) AS h, false AS reviewed, o % 4 < 2 AS superseded, false AS isoform, false AS other_release FROM o WHERE o % 3 = 0
  UNION ALL SELECT 'uniprot', 'Q' || o || CASE WHEN o % 8 = 1 THEN '-2' ELSE '' END, o, 1, sha256(CASE WHEN o % 5 = 0 THEN 'x' || o ELSE CAST(o % 400 AS VARCHAR) END), o % 16 = 1, false, o % 8 = 1, o % 32 = 5 FROM o WHERE o % 4 = 1
  UNION ALL SELECT 'ensembl', 'E' || o, o, 3, sha256(CAST(o % 400 AS VARCHAR)), false, false, false, false FROM o WHERE o % 2000 = 7),
pair AS (SELECT r.o AS p, r.accession, r.direct AS rank FROM record r WHERE r.direct < 3 UNION ALL SELECT w.o, r.accession, 3 FROM record r JOIN own w USING (h)),
best AS (SELECT p, accession, min(rank) AS rank FROM pair GROUP BY ALL),
linked AS (SELECT 'P' || p AS product_id, r.database, r.accession, ['product', 'accession', 'sequence'][rank] AS link, reviewed, superseded, isoform, other_release, r.h = w.h AS same
  FROM best b JOIN record r USING (accession) JOIN own w ON w.o = b.p),
classed AS (SELECT *, CASE WHEN same THEN 'match' WHEN other_release OR superseded OR isoform THEN 'warning' ELSE 'manual_review' END AS class FROM linked)
"""


@query(_BASE + """, shown AS (SELECT database, accession, link, class, superseded, isoform, other_release, reviewed, 1 AS products, product_id FROM classed WHERE link <> 'sequence'
  UNION ALL SELECT database, accession, 'sequence', 'match', superseded, isoform, false, reviewed, n, NULL FROM record JOIN (SELECT h, count(*) AS n FROM own GROUP BY h) USING (h))
SELECT database, link, class, superseded, isoform, other_release, reviewed, count(*) AS n, CAST(sum(products) AS BIGINT) AS products, min(product_id) AS first_product, min(accession) AS first_accession FROM shown GROUP BY ALL""")
def map_external_links(spark, sf_dir):
    """Kinds of links between products and external records, with their counts."""
    found = reconcile.classified(reconcile.links(*_inputs(spark, sf_dir)))
    kinds = ["database", "link", "class", "superseded", "isoform", "other_release", "reviewed"]
    return found.groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"), F.sum("products").alias("products"), F.min("product_id").alias("first_product"), F.min("accession").alias("first_accession"))


@query(_BASE + """SELECT 'P' || o.o AS product_id, true AS in_gencode, coalesce(bool_or(database = 'ensembl'), false) AS in_ensembl, o.o % 12 = 0 AS mane_select, o.o % 24 = 5 AS mane_plus_clinical,
coalesce(bool_or(database = 'uniprot' AND reviewed), false) AS uniprot_reviewed, coalesce(bool_or(database = 'uniprot' AND same), false) AS uniprot_match,
coalesce(bool_or(database = 'refseq' AND same), false) AS refseq_match, coalesce(bool_or(same), false) AS sequence_crossvalidated,
count(*) FILTER (WHERE class = 'match') AS matches, count(*) FILTER (WHERE class = 'warning') AS warnings, count(*) FILTER (WHERE class = 'manual_review') AS reviews,
CASE WHEN o.o % 13 = 0 THEN 'mapping_failure' WHEN count(*) FILTER (WHERE class = 'manual_review') > 0 THEN 'manual_review' WHEN count(*) FILTER (WHERE class = 'warning') > 0 THEN 'warning'
  WHEN count(*) FILTER (WHERE class = 'match') > 0 THEN 'match' ELSE 'no_record' END AS verdict
FROM o LEFT JOIN classed c ON c.product_id = 'P' || o.o GROUP BY o.o""")
def map_external_evidence(spark, sf_dir):
    """Evidence flags and verdict of every product."""
    products, *rest = _inputs(spark, sf_dir)
    return reconcile.evidence(products, reconcile.links(products, *rest))
