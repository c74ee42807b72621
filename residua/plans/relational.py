"""Queries on the star schema: lookups with fallback, semi and anti joins, resolution, aggregates, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from residua.operators import ledger
from residua.plans.registry import query
from residua.session import table


@query("""SELECT n_name, count(s_suppkey) AS suppliers, count(DISTINCT s_suppkey) AS ids, coalesce(bool_or(s_acctbal > 9000), false) AS rich,
CASE WHEN count(s_suppkey) = 0 THEN 'not_found' WHEN bool_or(s_acctbal < 0) THEN 'review' ELSE 'mapped' END AS status
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name""")
def rel_vocabulary_summary(spark, sf_dir):
    """A row for every name of a vocabulary, matched or not, with an ordered status."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    n = F.count("s_suppkey")
    status = F.when(n == 0, "not_found").when(F.bool_or(F.col("s_acctbal") < 0), "review").otherwise("mapped")
    rich = F.coalesce(F.bool_or(F.col("s_acctbal") > 9000), F.lit(False))
    return rows.groupBy("n_name").agg(n.alias("suppliers"), F.count_distinct("s_suppkey").alias("ids"), rich.alias("rich"), status.alias("status"))


@query("""WITH rep AS (SELECT c_nationkey, min(c_custkey) AS rep FROM customer GROUP BY 1)
SELECT s_suppkey, c.c_custkey AS exact_key, r.rep AS fallback_key, coalesce(c.c_custkey, r.rep) AS found
FROM supplier LEFT JOIN customer c ON c.c_custkey = s_suppkey * 100 LEFT JOIN rep r ON r.c_nationkey = s_nationkey""")
def rel_two_key_lookup(spark, sf_dir):
    """Exact key first, then the key of a coarser group."""
    customer = table(spark, sf_dir, "customer")
    rep = customer.groupBy("c_nationkey").agg(F.min("c_custkey").alias("fallback_key"))
    rows = table(spark, sf_dir, "supplier").withColumn("_k", F.col("s_suppkey") * 100)
    rows = rows.join(customer.select(F.col("c_custkey").alias("exact_key")), F.col("_k") == F.col("exact_key"), "left")
    rows = rows.join(rep, F.col("s_nationkey") == F.col("c_nationkey"), "left")
    return rows.select("s_suppkey", "exact_key", "fallback_key", F.coalesce("exact_key", "fallback_key").alias("found"))


@query("SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS flagged FROM orders")
def rel_flag_join(spark, sf_dir):
    hit = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(True).alias("flagged")).distinct()
    return table(spark, sf_dir, "orders").select("o_orderkey").join(hit, "o_orderkey", "left").fillna(False, ["flagged"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def rel_semi_join(spark, sf_dir):
    big = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").join(big, "o_orderkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def rel_anti_join(spark, sf_dir):
    """Customers without a large order."""
    have = table(spark, sf_dir, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(have, "c_custkey", "left_anti")


@query("""WITH t AS (SELECT upper(p_brand) AS token, 1 AS rank, p_partkey AS id FROM part
UNION ALL SELECT upper(unnest(string_split(p_type, ' '))), 2, p_partkey FROM part UNION ALL SELECT upper(unnest(string_split(p_name, ' '))), 3, p_partkey FROM part),
b AS (SELECT token, min(rank) AS best FROM t GROUP BY 1)
SELECT t.token, b.best AS method, count(DISTINCT id) AS candidates, CASE WHEN count(DISTINCT id) > 1 THEN NULL ELSE min(id) END AS resolved
FROM t JOIN b ON b.token = t.token AND t.rank = b.best GROUP BY ALL""")
def rel_token_resolution(spark, sf_dir):
    """Names from three sources; those of the best source decide, and only if they agree on one id."""
    part = table(spark, sf_dir, "part")

    def named(tokens, rank):
        return part.select(tokens.alias("token"), F.lit(rank).alias("rank"), F.col("p_partkey").alias("id"))

    t = named(F.upper("p_brand"), 1).unionByName(named(F.explode(F.split(F.upper("p_type"), " ")), 2)).unionByName(named(F.explode(F.split(F.upper("p_name"), " ")), 3))
    per = t.groupBy("token", "rank").agg(F.count_distinct("id").alias("n"), F.min("id").alias("id"))
    best = per.groupBy("token").agg(F.min(F.struct("rank", "n", "id")).alias("x"))
    return best.select("token", F.col("x.rank").alias("method"), F.col("x.n").alias("candidates"), F.when(F.col("x.n") == 1, F.col("x.id")).alias("resolved"))


@query("""WITH w AS (SELECT DISTINCT item_id, unnest(string_split(lower(text), ' ')) AS token FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(string_split(lower(text), ' '))) AS token FROM documents)
SELECT w.token, count(DISTINCT w.item_id) AS items, count(DISTINCT d.doc_id) AS documents FROM w JOIN d USING (token) WHERE w.token <> '' GROUP BY 1""")
def rel_token_containment(spark, sf_dir):
    """Where the words of small texts stand in large ones; words are counted on each side before they meet."""
    def words(name, key):
        t = table(spark, sf_dir, name).select(key, F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("token"))
        return t.filter(F.col("token") != "").groupBy("token").agg(F.count(F.lit(1)).alias("n"))  # an id holds a token once

    small, large = words("benchmark", "item_id"), words("documents", "doc_id")
    return small.withColumnRenamed("n", "items").join(large.withColumnRenamed("n", "documents"), "token")


@query("""SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS segments, bool_or(c_mktsegment = 'BUILDING') AS building
FROM customer GROUP BY 1""")
def rel_sorted_sets(spark, sf_dir):
    joined = F.array_join(F.array_sort(F.collect_set(F.nullif(F.col("c_mktsegment"), F.lit("")))), ";")
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(joined.alias("segments"), F.bool_or(F.col("c_mktsegment") == "BUILDING").alias("building"))


@query("""SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R') AS parts,
count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_orderkey END) AS open_orders FROM lineitem GROUP BY 1""")
def rel_conditional_counts(spark, sf_dir):
    back = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(back).alias("returned"),
        F.count_distinct(F.when(back, F.col("l_partkey"))).alias("parts"),
        F.count_distinct(F.when(F.col("l_linestatus") == "O", F.col("l_orderkey"))).alias("open_orders"),
    )


@query("""SELECT l_partkey, CASE WHEN count(DISTINCT CASE WHEN l_returnflag = 'R' THEN s_nationkey END) = 1 THEN min(CASE WHEN l_returnflag = 'R' THEN s_nationkey END)
WHEN count(DISTINCT CASE WHEN l_returnflag = 'R' THEN s_nationkey END) = 0 AND count(DISTINCT CASE WHEN l_returnflag = 'A' THEN s_nationkey END) = 1
THEN min(CASE WHEN l_returnflag = 'A' THEN s_nationkey END) ELSE -1 END AS chosen FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def rel_primary_selection(spark, sf_dir):
    """The only candidate of the first kind; without any, the only one of the second; else none."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    first, second = (F.when(F.col("l_returnflag") == f, F.col("s_nationkey")) for f in "RA")
    pick = F.when(F.count_distinct(first) == 1, F.min(first)).when((F.count_distinct(first) == 0) & (F.count_distinct(second) == 1), F.min(second)).otherwise(-1)
    return rows.groupBy("l_partkey").agg(pick.alias("chosen"))


@query("""SELECT source, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'es') AS es,
count(*) FILTER (WHERE lang = 'fr') AS fr FROM documents GROUP BY 1""")
def rel_crosstab(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).count().fillna(0)


@query("""SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1""")
def rel_first_and_last(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"), F.count_distinct("event_type").alias("kinds")
    )


@query("SELECT sha256(text) AS sequence_hash, count(DISTINCT source) AS sources FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def rel_having(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sequence_hash")).agg(F.count_distinct("source").alias("sources"))
    return rows.filter("sources > 1")


@query("SELECT DISTINCT lang, source FROM documents")
def rel_distinct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("lang", "source").distinct()


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier""")
def rel_union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"))
    return c.unionByName(s)


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 48")
def rel_except(spark, sf_dir):
    """Parts never sold in a large quantity."""
    large = table(spark, sf_dir, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey").subtract(large)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 200000")
def rel_half_open_range(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").filter((price >= 100_000) & (price < 200_000)).select("o_orderkey", "o_totalprice")


@query("SELECT doc_id FROM documents WHERE contains(text, 'a.') AND regexp_matches(text, '[*$^|]')")
def rel_literal_and_class(spark, sf_dir):
    """A literal that a pattern would read otherwise, and a class of characters that need an escape."""
    docs = table(spark, sf_dir, "documents")
    return docs.filter(F.col("text").contains("a.") & F.col("text").rlike(r"[\*\$\^\|]")).select("doc_id")


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY first) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2) GROUP BY 1""")
def rel_distinct_in_order(spark, sf_dir):
    """The distinct values of a column in the order in which they first come."""
    first = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))
    listed = F.array_sort(F.collect_list(F.struct("first", "event_type")))  # a user's few kinds of events
    return first.groupBy("user_id").agg(F.array_join(F.transform(listed, lambda x: x["event_type"]), ",").alias("kinds"))


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def rel_resume_pending(spark, sf_dir):
    return ledger.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT user_id, arg_max(event_type, event_id) AS status, max(event_id) AS attempt FROM events GROUP BY 1""")
def rel_ledger_latest(spark, sf_dir):
    attempts = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("status"), F.col("event_id").alias("attempt"))
    return ledger.latest(attempts, "user_id").select("user_id", "status", "attempt")


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem GROUP BY ALL""")
def rel_value_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n")
    )


@query("""SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 ORDER BY orders DESC, total DESC, o_custkey LIMIT 25""")
def rel_top_25(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sums.orderBy(F.desc("orders"), F.desc("total"), "o_custkey").limit(25)
