"""Queries on texts as sequences: hashing, classes, bins, windows, shards and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from residua.functions import columns as C
from residua.operators import batching, checks, greedy, metrics
from residua.plans.registry import query
from residua.session import table

BINS = [(0, 512), (513, 1022), (1023, 1500), (1501, 2000), (2001, 3000), (3001, 5000), (5001, 1_000_000_000)]
LABELS = ["0-512", "513-1022", "1023-1500", "1501-2000", "2001-3000", "3001-5000", ">5000"]
_BIN_CASE = "CASE " + " ".join(f"WHEN n_chars BETWEEN {a} AND {b} THEN {k}" for k, (a, b) in enumerate(BINS)) + " END"
_BIN_ROWS = ", ".join(f"({k}, '{x}')" for k, x in enumerate(LABELS))
SHARD_ROWS = 500
WINDOW, OVERLAP = 1022, 128


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(C.sequence_hash(F.col("text")).alias("sequence_hash"), "doc_id", "n_chars", "text")


@query("""SELECT sha256(text) AS sequence_hash, min(doc_id) AS doc_id, count(*) AS copies, max(n_chars) AS n_chars
FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def seq_dedup(spark, sf_dir):
    rows = _hashed(spark, sf_dir).filter(F.col("text").isNotNull())
    return rows.groupBy("sequence_hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars"))


@query("""SELECT sequence_hash, count(DISTINCT text) AS texts FROM (SELECT sha256(text) AS sequence_hash, text FROM documents UNION ALL SELECT sha256(text), text || ' changed' FROM documents WHERE doc_id % 10 = 0)
GROUP BY 1 HAVING count(DISTINCT text) > 1""")
def seq_hash_conflicts(spark, sf_dir):
    """Hashes with several texts, of which every tenth document is given a second one."""
    rows = _hashed(spark, sf_dir)
    changed = rows.filter("doc_id % 10 = 0").withColumn("text", F.concat("text", F.lit(" changed")))
    return checks.hash_conflicts(rows.unionByName(changed), "sequence_hash", "text")


@query(f"""SELECT b.k AS bin, b.label, count(d.doc_id) AS n, count(d.doc_id) * 100.0 / (SELECT count(*) FROM documents) AS percent
FROM (VALUES {_BIN_ROWS}) b(k, label) LEFT JOIN documents d ON {_BIN_CASE} = b.k GROUP BY 1, 2""")
def seq_length_bins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(C.length_bin(F.col("n_chars")).alias("bin"))
    counts = docs.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0))))  # a row a bin
    rows = spark.range(len(BINS)).select(F.col("id").cast("int").alias("bin")).join(counts.filter(F.col("bin").isNotNull()), "bin", "left").fillna(0, ["n"])
    rows = rows.withColumn("total", F.max("total").over(Window.partitionBy(F.lit(0))))
    return rows.select("bin", C.bin_label(F.col("bin")).alias("label"), "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))


@query("""SELECT count(n_chars) AS n, min(n_chars) AS least, max(n_chars) AS most, avg(n_chars) AS mean,
quantile_cont(n_chars, 0.5) AS p50, quantile_cont(n_chars, 0.9) AS p90, quantile_cont(n_chars, 0.95) AS p95,
quantile_cont(n_chars, 0.99) AS p99, quantile_cont(n_chars, 0.999) AS p999 FROM documents""")
def seq_length_statistics(spark, sf_dir):
    return metrics.length_statistics(table(spark, sf_dir, "documents"), "n_chars")


@query(f"""SELECT doc_id, s AS start, least({WINDOW}, n_chars - s) AS size FROM (
SELECT doc_id, n_chars, unnest(CASE WHEN n_chars <= {WINDOW} THEN [0]
ELSE list_distinct(list_append(generate_series(0, n_chars - {WINDOW}, {WINDOW - OVERLAP}), n_chars - {WINDOW})) END) AS s FROM documents)""")
def seq_windows(spark, sf_dir):
    from residua.operators.vectors import windows

    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars"))
    return windows(docs, "n_chars", WINDOW, OVERLAP).select("doc_id", F.col("start").cast("bigint").alias("start"), F.col("size").cast("bigint").alias("size"))


@query(f"""WITH w AS (SELECT doc_id, n_chars, unnest(CASE WHEN n_chars <= {WINDOW} THEN [0]
ELSE list_distinct(list_append(generate_series(0, n_chars - {WINDOW}, {WINDOW - OVERLAP}), n_chars - {WINDOW})) END) AS s FROM documents WHERE n_chars > 0),
z AS (SELECT doc_id, s, least({WINDOW}, n_chars - s) AS n FROM w),
p AS (SELECT doc_id, s + i AS pos, CASE WHEN n = 1 THEN 1.0 ELSE greatest(1 - abs(-1 + 2.0 * i / (n - 1)), 1.0 / n) END AS w FROM z, unnest(range(0, n)) AS u(i)),
q AS (SELECT doc_id, pos, sum(w) AS w FROM p GROUP BY ALL)
SELECT doc_id, count(*) AS positions, round(sum(w), 6) AS total, round(min(w), 6) AS least FROM q GROUP BY doc_id""")
def seq_taper_coverage(spark, sf_dir):
    """Sum of triangular window weights over the positions of every text."""
    from residua.operators.vectors import taper_coverage

    docs = table(spark, sf_dir, "documents").filter("n_chars > 0").select("doc_id", "n_chars")
    out = taper_coverage(docs, "doc_id", "n_chars", WINDOW, OVERLAP, "triangular")
    return out.select("doc_id", "positions", F.round("total", 6).alias("total"), F.round("least", 6).alias("least"))


_STOPS = "length(text) - length(replace(text, '*', ''))"


@query(f"""SELECT doc_id, CASE WHEN {_STOPS} = 0 THEN 'none' WHEN {_STOPS} > 1 THEN 'multiple_stops'
WHEN text LIKE '%*' THEN 'terminal_stop' ELSE 'internal_stop' END AS stop_class FROM documents WHERE text IS NOT NULL""")
def seq_stop_class(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull())
    return docs.select("doc_id", C.stop_class(F.col("text")).alias("stop_class"))


@query("""SELECT item_id, array_to_string(list_filter(generate_series(1, length(text)), lambda i: substr(text, i, 1) = '.'), ',') AS places
FROM benchmark""")
def seq_stop_positions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", C.stop_positions(F.col("text"), ".").alias("places"))


@query(f"""SELECT item_id, array_to_string(list_sort(list_distinct(list_filter(string_split(text, ''), lambda c: c <> '' AND NOT contains('{C.RESIDUES}', c)))), ';') AS issue
FROM benchmark""")
def seq_residue_issues(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", C.sequence_issue(F.col("text")).alias("issue"))


@query("""SELECT c AS character, count(*) AS occurrences, count(DISTINCT item_id) AS texts FROM (
SELECT item_id, unnest(string_split(text, '')) AS c FROM benchmark) WHERE c <> '' GROUP BY 1""")
def seq_character_audit(spark, sf_dir):
    letters = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", "")).alias("character")).filter(F.col("character") != "")
    return letters.groupBy("character").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("item_id").alias("texts"))


@query(f"""WITH h AS (SELECT sha256(text) AS sequence_hash, min(n_chars) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY 1),
s AS (SELECT *, (row_number() OVER (ORDER BY sequence_hash) - 1) // {SHARD_ROWS} AS shard_id FROM h)
SELECT CAST(shard_id AS INTEGER) AS shard_id, count(*) AS row_count, min(sequence_hash) AS first_sequence_hash, max(sequence_hash) AS last_sequence_hash,
sha256(string_agg(sequence_hash, chr(10) ORDER BY sequence_hash)) AS content_sha256, printf('sequence_shard_%04d.parquet', shard_id) AS filename FROM s GROUP BY shard_id""")
def seq_shard_manifest(spark, sf_dir):
    rows = _hashed(spark, sf_dir).filter(F.col("text").isNotNull()).groupBy("sequence_hash").agg(F.min("n_chars").alias("n_chars"))
    return batching.shard_manifest(batching.assign_shards(rows, size=SHARD_ROWS))


@query(f"""WITH RECURSIVE h AS (SELECT sha256(text) AS sequence_hash, min(n_chars) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1),
s AS (SELECT *, (row_number() OVER (ORDER BY sequence_hash) - 1) // {SHARD_ROWS} AS shard_id FROM h),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY n, sequence_hash) AS rn FROM s),
f AS (SELECT shard_id, rn, sequence_hash, n, 0 AS batch_id, 1 AS held FROM o WHERE rn = 1
UNION ALL SELECT o.shard_id, o.rn, o.sequence_hash, o.n,
CASE WHEN f.held >= 16 OR (o.n + 2) * (f.held + 1) > 8192 THEN f.batch_id + 1 ELSE f.batch_id END,
CASE WHEN f.held >= 16 OR (o.n + 2) * (f.held + 1) > 8192 THEN 1 ELSE f.held + 1 END
FROM f JOIN o ON o.shard_id = f.shard_id AND o.rn = f.rn + 1)
SELECT CAST(shard_id AS INTEGER) AS shard_id, sequence_hash, n AS length, CAST(batch_id AS INTEGER) AS batch_id FROM f""")
def seq_length_batches(spark, sf_dir):
    rows = _hashed(spark, sf_dir).filter(F.col("text").isNotNull()).groupBy("sequence_hash").agg(F.min("n_chars").alias("length"))
    sharded = batching.assign_shards(rows, size=SHARD_ROWS)
    return batching.length_batches(sharded, "sequence_hash", "length", 8192, 16, ["shard_id"]).select("shard_id", "sequence_hash", "length", "batch_id")


@query("""WITH RECURSIVE o AS MATERIALIZED (SELECT sequence_hash, n, row_number() OVER (ORDER BY n, sequence_hash) AS rn
  FROM (SELECT sha256(text) AS sequence_hash, min(n_chars) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1)),
f AS (SELECT rn, sequence_hash, n, 0 AS batch_id, 1 AS held FROM o WHERE rn = 1
UNION ALL SELECT o.rn, o.sequence_hash, o.n,
CASE WHEN f.held >= 16 OR (o.n + 2) * (f.held + 1) > 8192 THEN f.batch_id + 1 ELSE f.batch_id END,
CASE WHEN f.held >= 16 OR (o.n + 2) * (f.held + 1) > 8192 THEN 1 ELSE f.held + 1 END
FROM f JOIN o ON o.rn = f.rn + 1)
SELECT sequence_hash, n AS length, CAST(batch_id AS INTEGER) AS batch_id, rn - 1 AS place FROM f""")
def seq_greedy_batches(spark, sf_dir):
    """Length-aware batches over the whole table as one sequence of rows, in small blocks that batches run across."""
    rows = _hashed(spark, sf_dir).filter(F.col("text").isNotNull()).groupBy("sequence_hash").agg(F.min("n_chars").alias("length"))
    return greedy.greedy_batches(rows, "sequence_hash", "length", 8192, 16, block=256)


@query(f"""WITH h AS (SELECT sha256(text) AS sequence_hash, min(n_chars) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY 1)
SELECT bin, sequence_hash, n_chars FROM (SELECT {_BIN_CASE} AS bin, sequence_hash, n_chars FROM h)
QUALIFY row_number() OVER (PARTITION BY bin ORDER BY sequence_hash) <= 5""")
def seq_top_per_bin(spark, sf_dir):
    rows = _hashed(spark, sf_dir).filter(F.col("text").isNotNull()).groupBy("sequence_hash").agg(F.min("n_chars").alias("n_chars"))
    return batching.top_per_bin(rows.withColumn("bin", C.length_bin(F.col("n_chars"))), "bin", "sequence_hash", 5).select("bin", "sequence_hash", "n_chars")


@query("""SELECT count(*) AS sequences, CAST(sum(n_chars) AS BIGINT) AS residues, round(count(*) * 1280 * 4.0 / 1073741824, 6) AS mean_gib,
round(sum(n_chars) * 1280 * 2.0 / 1073741824, 6) AS half_residue_gib FROM documents""")
def seq_storage_estimate(spark, sf_dir):
    sums = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("sequences"), F.sum("n_chars").alias("residues"))
    return sums.select(
        "sequences", "residues", F.round(C.gib(F.col("sequences"), 1280, 4), 6).alias("mean_gib"), F.round(C.gib(F.col("residues"), 1280, 2), 6).alias("half_residue_gib")
    )


@query("""SELECT page_id, u.z[1] AS key, u.z[2] AS value FROM (SELECT page_id, regexp_extract_all(html, '([^\\t\\n\\v\\f\\r >]+)[=]"([^"]*)"', 1) AS ks,
regexp_extract_all(html, '([^\\t\\n\\v\\f\\r >]+)[=]"([^"]*)"', 2) AS vs FROM pages), unnest(list_zip(ks, vs)) WITH ORDINALITY AS u(z, i)
QUALIFY row_number() OVER (PARTITION BY page_id, u.z[1] ORDER BY u.i DESC) = 1""")
def seq_attributes(spark, sf_dir):
    """Attributes of pages as maps, the last value of a repeated key counting."""
    pairs = F.regexp_replace("html", r'([^\t\n\x0b\f\r >]+)="([^"]*)"', ' $1 "$2" ')
    kept = F.array_join(F.regexp_extract_all(pairs, F.lit(r' [^\t\n\x0b\f\r >]+ "[^"]*" '), F.lit(0)), "")
    return table(spark, sf_dir, "pages").select("page_id", F.explode(C.attributes(kept)).alias("key", "value"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(upper(p_type), 'STEEL$') THEN 'steel' WHEN upper(p_type) LIKE 'PROMO%' THEN 'promo' ELSE 'other' END AS kind FROM part""")
def seq_ordered_rules(spark, sf_dir):
    kind = F.upper("p_type")
    rule = F.when(kind.rlike("STEEL$"), "steel").when(kind.startswith("PROMO"), "promo").otherwise("other")
    return table(spark, sf_dir, "part").select("p_partkey", rule.alias("kind"))


@query("""SELECT s_suppkey, regexp_extract(v, '^(ENS[GPT][0-9]+)(\\.[0-9]+)?$', 1) AS stable FROM (
SELECT s_suppkey, 'ENSG' || lpad(CAST(s_suppkey AS VARCHAR), 11, '0') || '.' || (s_suppkey % 7) AS v FROM supplier)""")
def seq_stable_ids(spark, sf_dir):
    v = F.concat(F.lit("ENSG"), F.lpad(F.col("s_suppkey").cast("string"), 11, "0"), F.lit("."), (F.col("s_suppkey") % 7).cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", C.stable_id(v).alias("stable"))
