"""Queries of joins with contracts, unions, merge rules and acceptance of whole groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merging, quality
from ..sources import table
from .registry import off_grid, query, r6


def _totals(spark, d, where=None, out="total"):
    o = table(spark, d, "orders", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    o = o.where(where) if where else o
    return o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(off_grid(F.sum("o_totalprice")).alias(out), F.count(F.lit(1)).alias("n"))


@query("""
WITH t AS (SELECT o_custkey, round(sum(o_totalprice) + 1.37e-5, 4) AS total, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey, c_custkey + 1 AS place, total, n FROM customer LEFT JOIN t ON c_custkey = o_custkey
""")
def ordered_one_to_one(spark, d):
    left = table(spark, d, "customer", "c_custkey").withColumn("place", F.col("c_custkey") + 1)
    return merging.one_to_one(left, _totals(spark, d), ["c_custkey"])


@query("SELECT o_custkey AS c_custkey, n FROM orders LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = k")
def reindexed(spark, d):
    index = table(spark, d, "orders", "o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    return merging.reindex(index, _totals(spark, d, "o_orderstatus = 'P'").select("c_custkey", "n"), ["c_custkey"])


@query("""
SELECT c_custkey, c_name, bal AS c_acctbal, seg AS c_mktsegment FROM customer LEFT JOIN (SELECT c_custkey AS k, c_acctbal * 2 AS bal, lower(c_mktsegment) AS seg FROM customer WHERE c_acctbal > 0) ON c_custkey = k
""")
def replaced_columns(spark, d):
    base = table(spark, d, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    new = base.where("c_acctbal > 0").select("c_custkey", (F.col("c_acctbal") * 2).alias("c_acctbal"), F.lower("c_mktsegment").alias("c_mktsegment"))
    return merging.replace_columns(base, new, ["c_custkey"])


@query("""
WITH r AS (SELECT DISTINCT l_partkey, l_suppkey, 0 AS s FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30 UNION ALL SELECT DISTINCT l_partkey, l_suppkey, 1 FROM lineitem WHERE l_discount > 0.08),
h AS (SELECT l_partkey, count(DISTINCT s) AS n FROM r GROUP BY 1), a AS (SELECT r.l_partkey, l_suppkey FROM r JOIN h ON r.l_partkey = h.l_partkey GROUP BY ALL HAVING count(*) = max(n))
SELECT * FROM a UNION ALL SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM h)
""")
def shared_suppliers(spark, d):
    lines = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_discount")
    return merging.shared_candidates([lines.where("l_returnflag = 'R' and l_quantity > 30"), lines.where("l_discount > 0.08")], lines, "l_partkey", "l_suppkey")


@query("SELECT l_partkey, count(*) AS n, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem GROUP BY 1")
def equal_key_merge(spark, d):
    lines = table(spark, d, "lineitem", "l_partkey", "l_quantity")
    return merging.equal_keys(lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")), lines.groupBy("l_partkey").agg(r6(F.avg("l_quantity")).alias("mean_quantity")), ["l_partkey"])


@query("""
SELECT 'c' AS kind, c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS size FROM customer
UNION ALL SELECT 's', s_suppkey, s_acctbal, NULL, NULL FROM supplier UNION ALL SELECT 'p', p_partkey, NULL, NULL, p_size FROM part
""")
def column_union(spark, d):
    c = table(spark, d, "customer").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    p = table(spark, d, "part").select(F.lit("p").alias("kind"), F.col("p_partkey").alias("key"), F.col("p_size").alias("size"))
    return merging.union_columns(c, s, p)


@query("""
WITH o AS (SELECT o_custkey AS k, year(o_orderdate) AS y, CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 2 END AS level FROM orders),
a AS (SELECT k, max(y) AS y, count(*) AS n, max(level) AS level FROM o WHERE y <= 1996 GROUP BY 1), b AS (SELECT k, max(y) AS y, count(*) AS n, max(level) AS level FROM o WHERE y > 1994 GROUP BY 1),
j AS (SELECT c_custkey, a.y AS ay, a.n AS an, a.level AS al, b.y AS bq, b.n AS bn, b.level AS bl FROM customer LEFT JOIN a ON c_custkey = a.k LEFT JOIN b ON c_custkey = b.k),
x AS (SELECT *, CASE WHEN bq IS NULL THEN 'keep' WHEN ay IS NULL THEN 'insert' WHEN (bq > ay AND (bn >= 0.6 * an OR bq - ay >= 2)) OR (al = 1 AND bl > 1) THEN 'replace' ELSE 'keep' END AS action FROM j)
SELECT c_custkey, CASE WHEN action = 'keep' THEN ay ELSE bq END AS y, CASE WHEN action = 'keep' THEN an ELSE bn END AS n, CASE WHEN action = 'keep' THEN al ELSE bl END AS level, action FROM x
""")
def newer_blocks(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_orderpriority").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"), F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(2).alias("level"))
    block = lambda rows: rows.groupBy("c_custkey").agg(F.max("y").alias("y"), F.count(F.lit(1)).alias("n"), F.max("level").alias("level"))
    base = merging.reindex(table(spark, d, "customer", "c_custkey"), block(o.where("y <= 1996")), ["c_custkey"])
    return merging.newer_block(base, block(o.where("y > 1994")), "c_custkey", "y", "n", "level")


@query("""
WITH t AS (SELECT o_custkey AS k, sum(o_totalprice) AS total, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN round(total / n + 1.37e-5, 4) END AS mean, CASE WHEN coalesce(n, 0) > 5 THEN 1 ELSE 0 END AS regular FROM customer LEFT JOIN t ON c_custkey = k
""")
def derived_after_merge(spark, d):
    t = table(spark, d, "orders", "o_custkey", "o_totalprice", "o_orderstatus").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"))
    merged = merging.reindex(table(spark, d, "customer", "c_custkey"), t, ["c_custkey"])
    n = F.col("n")
    return merging.recomputed(merged, {"mean": F.when(n > 0, off_grid(F.col("total") / F.nullif(n, F.lit(0)))), "regular": F.when(n > 5, 1).otherwise(0)}, {"n": 0}).drop("total")


@query("""
SELECT o_orderpriority, name, filled FROM (
  SELECT o_orderpriority, count(*) FILTER (o_totalprice > 200000) AS large, count(*) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY 1
) UNPIVOT (filled FOR name IN (large, done))
""")
def filled_by_partition(spark, d):
    o = table(spark, d, "orders", "o_orderpriority", "o_totalprice", "o_orderstatus")
    return merging.in_every_partition(o.withColumns({"large": F.when(F.col("o_totalprice") > 200000, 1), "done": F.when(F.col("o_orderstatus") == "F", 1)}), "o_orderpriority", ["large", "done"])


@query("""
SELECT user_id, arg_max(value, (ts, event_id)) FILTER (value > 20) AS high, arg_max(event_type, (ts, event_id)) FILTER (event_type <> 'error') AS last_kind FROM events GROUP BY 1
""")
def last_written_fields(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_id", "value", "event_type")
    return merging.last_written(e.select("user_id", "ts", "event_id", F.when(F.col("value") > 20, F.col("value")).alias("high"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("last_kind")), ["user_id"], ["ts", "event_id"], ["high", "last_kind"])


_UNION_SQL = """
WITH u AS (SELECT 0 AS f, user_id, event_type, ts, event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-10' UNION ALL SELECT 1, user_id, event_type, ts, event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-05')
SELECT user_id, event_type, event_id, value FROM u QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY f {0}, ts {0}, event_id {0}) = 1
"""


def _two_feeds(spark, d):
    e = table(spark, d, "events", "user_id", "event_type", "ts", "event_id", "value")
    at = lambda day: F.expr(f"timestamp_ntz'{day} 00:00:00'")
    return [e.where(F.col("ts") < at("2024-01-10")), e.where(F.col("ts") >= at("2024-01-05"))]


@query(_UNION_SQL.format("DESC"))
def union_keep_last(spark, d):
    return merging.union_keeping(_two_feeds(spark, d), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query(_UNION_SQL.format("ASC"))
def union_keep_first(spark, d):
    return merging.union_keeping(_two_feeds(spark, d), ["user_id", "event_type"], ["ts", "event_id"], last=False).select("user_id", "event_type", "event_id", "value")


@query("""
WITH q AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1), p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS ra, row_number() OVER (ORDER BY q DESC, p_partkey) AS rb FROM part JOIN q ON p_partkey = l_partkey)
SELECT k, count(*) FILTER (ra <= k AND rb <= k) AS shared FROM p, (VALUES (50), (100)) t(k) GROUP BY 1
""")
def topk_overlap(spark, d):
    q = table(spark, d, "lineitem", "l_partkey", "l_quantity").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    p = table(spark, d, "part", "p_partkey", "p_retailprice").join(q, F.col("p_partkey") == F.col("l_partkey"))
    return merging.top_overlap(p, "p_partkey", "p_retailprice", "q", (50, 100))


@query("SELECT CASE WHEN c_custkey % 3 = 0 THEN 'query' ELSE 'train' END AS side, count(*) AS n FROM customer GROUP BY 1")
def disjoint_sides(spark, d):
    c = table(spark, d, "customer", "c_custkey").withColumn("side", F.when(F.col("c_custkey") % 3 == 0, "query").otherwise("train"))
    return merging.disjoint_or_fail(c, "c_custkey", "side").groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderkey % 50 <> 1 THEN o_custkey END AS grp, o_totalprice > 440000 AS bad FROM orders),
f AS (SELECT *, grp IS NOT NULL AND max(CASE WHEN bad AND grp IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY y, grp) = 1 AS own, max(CASE WHEN bad AND grp IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY y) = 1 AS wide FROM o)
SELECT y, count(*) AS n, count(*) FILTER (own OR wide) AS refused FROM f GROUP BY 1
""")
def wide_quarantine(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_custkey", "o_totalprice").withColumns({"y": F.year("o_orderdate"), "grp": F.when(F.col("o_orderkey") % 50 != 1, F.col("o_custkey"))})
    return o.withColumn("out", merging.wide_quarantine(o, "grp", "y", F.col("o_totalprice") > 440000)).groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count_if("out").alias("refused"))


@query("""
SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, CASE WHEN count(*) FILTER (o_totalprice > 5000) < count(*) THEN 'refused rows' WHEN count(*) < 2 THEN 'too few' WHEN count(*) FILTER (month(o_orderdate) BETWEEN 2 AND 11) < count(*) THEN 'outside the window' ELSE 'accepted' END AS verdict FROM orders GROUP BY 1, 2
""")
def complete_groups(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice").withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    return merging.complete_groups(o, ["o_custkey", "y"], F.col("o_totalprice") > 5000, "m", (F.lit(2), F.lit(11)), 2)


@query("""
WITH a AS (SELECT l_suppkey AS k, count(*) AS v FROM lineitem GROUP BY 1), s AS (SELECT year(l_shipdate) AS snapshot, l_suppkey, count(*) AS v FROM lineitem GROUP BY ALL),
c AS (SELECT l_suppkey % 100 AS board, l_suppkey, count(*) FILTER (l_shipdate < TIMESTAMP '2000-01-01' OR l_suppkey % 100 < 40) AS v FROM lineitem GROUP BY ALL),
j AS (SELECT c.*, count(a.v) OVER w AS told, count(*) FILTER (a.v = c.v) OVER w AS same FROM c LEFT JOIN a ON l_suppkey = k WINDOW w AS (PARTITION BY board))
SELECT board, l_suppkey, v FROM j WHERE NOT (told > 0 AND told = same)
""")
def foretelling_snapshots(spark, d):
    lines = table(spark, d, "lineitem", "l_suppkey", "l_shipdate")
    actual = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("v"))
    early = (F.col("l_shipdate") < F.expr("timestamp_ntz'2000-01-01 00:00:00'")) | (F.col("l_suppkey") % 100 < 40)
    boards = lines.groupBy((F.col("l_suppkey") % 100).alias("board"), "l_suppkey").agg(F.count_if(early).alias("v"))
    return merging.not_stale(boards, actual, "board", "l_suppkey", "v")


@query("""
WITH i AS (SELECT l_partkey, l_suppkey, min(l_linestatus) AS label, min(l_linestatus) <> max(l_linestatus) AS differs FROM lineitem GROUP BY ALL)
SELECT l_partkey, l_suppkey, label AS l_linestatus FROM i WHERE l_partkey NOT IN (SELECT l_partkey FROM i WHERE differs)
""")
def undisputed_labels(spark, d):
    return merging.undisputed(table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_linestatus"), "l_partkey", "l_suppkey", "l_linestatus")


@query("SELECT doc_id, n_chars FROM documents")
def public_columns(spark, d):
    return merging.without_labels(table(spark, d, "documents", "doc_id", "n_chars"), ("toxic", "quality", "label", "truth"))


@query("SELECT o_orderpriority, o_orderstatus, grouping(o_orderpriority)::BIGINT * 2 + grouping(o_orderstatus)::BIGINT AS level, count(*) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)")
def coverage_cube(spark, d):
    """Counts by both keys, either and none: grouping sets in one pass."""
    return table(spark, d, "orders", "o_orderpriority", "o_orderstatus").cube("o_orderpriority", "o_orderstatus").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) AS place FROM orders")
def multi_key_order(spark, d):
    """Rows of a customer by three keys in mixed directions."""
    from pyspark.sql import Window

    return table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice").select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderpriority"), "o_totalprice", "o_orderkey")).cast("long").alias("place"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_partkey AS a, 1000000000 + l_orderkey AS b FROM lineitem WHERE l_quantity > 49), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(n, m) AS (SELECT a, a FROM u UNION SELECT u.b, r.m FROM r JOIN u ON r.n = u.a), c AS (SELECT n, min(m) AS root FROM r GROUP BY 1)
SELECT root, count(*) AS nodes FROM c GROUP BY 1
""")
def linked_components(spark, d):
    """Parts that orders of fifty pieces link, with the size of each component."""
    from ..operators.graph import components

    edges = table(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_quantity").where("l_quantity > 49").select(F.col("l_partkey").alias("a"), (F.col("l_orderkey") + 1000000000).alias("b"))
    return components(edges).groupBy("root").agg(F.count(F.lit(1)).alias("nodes"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1)")
def consistent_keys(spark, d):
    from ..operators.identity import consistent

    o = consistent(table(spark, d, "orders", "o_custkey", "o_orderstatus"), "o_custkey", "o_orderstatus").select("o_custkey").distinct()
    return quality.unique_or_fail(o, ["o_custkey"]).select(F.col("o_custkey").alias("c_custkey"))
