"""Queries of cohorts over time: peers, seasons, shrinkage, folds, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cohorts
from ..sources import table
from .registry import off_grid, query, r6


def _year(c):
    return F.year(c).alias("y")


@query("""
WITH r AS (SELECT s_suppkey, round((rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) - 1 + (count(*) OVER (PARTITION BY s_nationkey, s_acctbal) - 1) / 2.0::DOUBLE) / nullif(count(s_acctbal) OVER (PARTITION BY s_nationkey) - 1, 0), 6) AS place FROM supplier)
SELECT * FROM r
""")
def peer_rank(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    return s.select("s_suppkey", r6(cohorts.peer_rank(F.col("s_acctbal"), ["s_nationkey"])).alias("place"))


@query("SELECT o_orderkey, rank() OVER (PARTITION BY year(o_orderdate), o_orderpriority ORDER BY o_totalprice DESC) AS place FROM orders")
def competition_rank(spark, d):
    """Rank from the top within a year and priority; equal values share the least rank."""
    from pyspark.sql import Window

    o = table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    return o.select("o_orderkey", F.rank().over(Window.partitionBy(F.year("o_orderdate"), "o_orderpriority").orderBy(F.desc("o_totalprice"))).cast("long").alias("place"))


@query("""
WITH e AS (SELECT user_id, ts::DATE AS day, value FROM events), x AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS b, max(day) OVER (PARTITION BY user_id) AS z FROM e)
SELECT user_id, round(avg(value) FILTER (day - b < 7), 6) AS first_7, round(avg(value) FILTER (day - b < 14), 6) AS first_14, round(avg(value) FILTER (z - day < 7), 6) AS last_7 FROM x GROUP BY 1
""")
def first_and_last_days(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "value").select("user_id", F.to_date("ts").alias("day"), "value")
    m = cohorts.first_and_last_means(e, "user_id", "day", "value", (7, 14), 7)
    return m.select("user_id", *[r6(F.col(c)).alias(c) for c in m.columns[1:]])


@query("""
WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM events), s AS (SELECT *, greatest(1, n // 7) AS step FROM n)
SELECT user_id, event_id FROM s WHERE (p % step = 0 AND p < step * 7) OR p = n - 1
""")
def spread_snapshots(spark, d):
    return cohorts.spread_sample(table(spark, d, "events", "user_id", "ts", "event_id"), "user_id", ["ts", "event_id"], 7).select("user_id", "event_id")


@query("""
WITH s AS (SELECT o_custkey, year(o_orderdate) AS y, max(o_totalprice) AS v FROM orders GROUP BY 1, 2), n AS (SELECT * FROM s QUALIFY y >= max(y) OVER (PARTITION BY o_custkey) - 2)
SELECT o_custkey, CASE WHEN count(*) >= 2 THEN CAST(arg_max(v, y) - arg_min(v, y) >= 50000 AS INTEGER) END AS flag FROM n GROUP BY 1
""")
def still_growing(spark, d):
    s = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice").groupBy("o_custkey", _year("o_orderdate")).agg(F.max("o_totalprice").alias("v"))
    return cohorts.still_growing(s, "o_custkey", "y", "v", least=50_000)


@query("""
WITH s AS (SELECT o_custkey, year(o_orderdate) AS y, min(o_orderpriority) AS p FROM orders GROUP BY 1, 2), l AS (SELECT *, lag(y) OVER w AS b, lag(p) OVER w AS t FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY y, p))
SELECT o_custkey, max(coalesce(CAST(y - b > 1 AND p = t AS INTEGER), 0)) AS gap FROM l GROUP BY 1
""")
def same_place_gaps(spark, d):
    s = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_orderpriority").groupBy("o_custkey", _year("o_orderdate")).agg(F.min("o_orderpriority").alias("p"))
    return cohorts.same_place_gap(s, "o_custkey", "y", "p")


@query("""
WITH l AS (SELECT l_suppkey, year(l_shipdate) AS y, l_linenumber::DOUBLE AS gp, l_quantity AS mpg, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS ppg, CASE WHEN l_discount > 0 THEN l_discount END AS pct FROM lineitem)
SELECT l_suppkey, y, sum(gp) AS gp, round(sum(gp * mpg) / sum(gp), 6) AS mpg, round(CASE WHEN count(ppg) > 0 THEN sum(coalesce(gp * ppg, 0)) / sum(gp) END + 1.37e-5, 4) AS ppg,
  round(sum(gp * mpg * pct) / sum(gp * mpg) FILTER (pct IS NOT NULL), 6) AS pct FROM l GROUP BY 1, 2 HAVING sum(gp * mpg) > 0
""")
def season_lines(spark, d):
    lines = table(spark, d, "lineitem", "l_suppkey", "l_shipdate", "l_linenumber", "l_quantity", "l_returnflag", "l_extendedprice", "l_discount").select(
        "l_suppkey", _year("l_shipdate"), F.col("l_linenumber").cast("double").alias("gp"), F.col("l_quantity").alias("mpg"), F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("ppg"), F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("pct")
    )
    s = cohorts.season_lines(lines, ["l_suppkey", "y"], "gp", "mpg", ["ppg"], ["pct"])
    return s.select("l_suppkey", "y", "gp", r6(F.col("mpg")).alias("mpg"), off_grid(F.col("ppg")).alias("ppg"), r6(F.col("pct")).alias("pct"))


@query("""
WITH s AS (SELECT l_suppkey, s_nationkey AS g, count(*) FILTER (l_returnflag = 'R')::DOUBLE AS made, count(*)::DOUBLE AS tried FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL), r AS (SELECT *, made / tried AS rate FROM s),
p AS (SELECT g, avg(rate) AS m, var_pop(rate) AS v, count(*) AS n FROM r GROUP BY 1 HAVING count(*) >= 5), a AS (SELECT avg(rate) AS m, var_pop(rate) AS v FROM r),
k AS (SELECT r.*, coalesce(p.m, a.m) AS m, CASE WHEN p.m IS NOT NULL THEN least(greatest(p.m * (1 - p.m) / p.v - 1, 2), 200) ELSE least(greatest(a.m * (1 - a.m) / a.v - 1, 2), 200) END AS k FROM r LEFT JOIN p ON r.g = p.g, a)
SELECT l_suppkey, round((made + m * k) / (tried + k), 6) AS posterior FROM k
""")
def beta_posteriors(spark, d):
    j = table(spark, d, "lineitem", "l_suppkey", "l_returnflag").join(table(spark, d, "supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    s = j.groupBy("l_suppkey", "s_nationkey").agg(F.count_if(F.col("l_returnflag") == "R").cast("double").alias("made"), F.count(F.lit(1)).cast("double").alias("tried"))
    return cohorts.beta_posterior(s, "s_nationkey", "made", "tried", 5).select("l_suppkey", r6(F.col("posterior")).alias("posterior"))


@query("""
WITH s AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS m, count(*) AS n, avg(o_totalprice) AS x FROM orders GROUP BY 1), t AS (SELECT avg(x) AS mean FROM s WHERE o_custkey % 3 <> 0)
SELECT o_custkey, round((m + 0.5 * 12) / (n + 12), 6) AS posterior, round(n / (n + 10.0) * x + (1 - n / (n + 10.0)) * mean + 1.37e-5, 4) AS drawn FROM s, t
""")
def fixed_shrinkage(spark, d):
    """A posterior with a fixed prior, and a mean drawn to that of training customers by reliability."""
    s = table(spark, d, "orders", "o_custkey", "o_orderstatus", "o_totalprice").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("m"), F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("x"))
    mean = s.where("o_custkey % 3 <> 0").agg(F.avg("x")).scalar()
    return s.select("o_custkey", r6(cohorts.fixed_posterior(F.col("m"), F.col("n"), 0.5, 12)).alias("posterior"), off_grid(cohorts.reliable(F.col("x"), F.col("n"), 10.0, mean)).alias("drawn"))


@query("""
WITH s AS (SELECT o_custkey, year(o_orderdate)::DOUBLE - 1995 AS x, count(*)::DOUBLE AS v FROM orders GROUP BY 1, 2), f AS (SELECT *, min(x) OVER (PARTITION BY o_custkey) AS c FROM s),
r AS (SELECT o_custkey, c, count(*) AS n, CASE WHEN count(*) >= 2 THEN (count(*) * sum(x * v) - sum(x) * sum(v)) / nullif(count(*) * sum(x * x) - sum(x) * sum(x), 0) END AS slope FROM f GROUP BY 1, 2),
p AS (SELECT c, sum(sum(slope)) OVER w / nullif(sum(count(slope)) OVER w, 0) AS p FROM r GROUP BY 1 WINDOW w AS (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT o_custkey, round(slope, 6) AS slope, round(CASE WHEN p IS NULL THEN slope ELSE n / (n + 2.0) * slope + (1 - n / (n + 2.0)) * p END, 6) AS shrunk FROM r JOIN p ON r.c = p.c
""")
def shrunk_slopes(spark, d):
    s = table(spark, d, "orders", "o_custkey", "o_orderdate").groupBy("o_custkey", (F.year("o_orderdate").cast("double") - 1995).alias("x")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    first = s.groupBy(F.col("o_custkey").alias("k")).agg(F.min("x").alias("c"))
    j = s.join(first, F.col("o_custkey") == F.col("k"))
    return cohorts.shrunk_slopes(j, "o_custkey", "c", "x", "v").select("o_custkey", r6(F.col("slope")).alias("slope"), r6(F.col("shrunk")).alias("shrunk"))


@query("""
WITH r AS (SELECT s_nationkey AS g, 2 * rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) + count(*) OVER (PARTITION BY s_nationkey, s_acctbal) - 1 AS a, 2 * rank() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey % 10) + count(*) OVER (PARTITION BY s_nationkey, s_suppkey % 10) - 1 AS b FROM supplier),
c AS (SELECT g, count(*) AS n, corr(a, b) AS r FROM r GROUP BY 1 HAVING count(*) >= 3 AND stddev_pop(a) > 0 AND stddev_pop(b) > 0)
SELECT round(sum(r * n) / nullif(sum(n), 0), 6) AS rho, coalesce(sum(n), 0)::BIGINT AS n FROM c
""")
def weighted_rank_correlation(spark, d):
    s = table(spark, d, "supplier", "s_nationkey", "s_acctbal", "s_suppkey").withColumn("m", F.col("s_suppkey") % 10)
    return cohorts.rank_correlation(s, "s_nationkey", "s_acctbal", "m", 3).select(r6(F.col("rho")).alias("rho"), F.col("n").cast("long").alias("n"))


@query("""
WITH o AS (SELECT o_totalprice AS y, ln(greatest(o_custkey, 1)) AS lp, o_orderkey::DOUBLE AS a, month(o_orderdate)::DOUBLE AS b FROM orders), s AS (SELECT covar_pop(lp, y) / var_pop(lp) AS k FROM o), r AS (SELECT y - k * lp AS l, a, b FROM o, s)
SELECT 'a' AS name, round(corr(a, l), 6) AS r FROM r UNION ALL SELECT 'b', round(corr(b, l), 6) FROM r
""")
def residual_correlations(spark, d):
    o = table(spark, d, "orders", "o_totalprice", "o_custkey", "o_orderkey", "o_orderdate").withColumns({"a": F.col("o_orderkey").cast("double"), "b": F.month("o_orderdate").cast("double")})
    return cohorts.residual_correlations(o, "o_totalprice", "o_custkey", ["a", "b"]).select("name", r6(F.col("r")).alias("r"))


_COVERED = {"a": ("c_acctbal > 1000", "c_acctbal"), "b": ("c_nationkey < 12", "c_nationkey"), "c": ("c_custkey % 4 = 0", "c_custkey"), "e": ("c_mktsegment = 'BUILDING'", "c_custkey")}


def _sparse(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    return c.select("c_custkey", *[F.when(F.expr(w), F.col(x)).alias(k) for k, (w, x) in _COVERED.items()])


_COUNT = " + ".join(f"CAST({w} AS INTEGER)" for w, _ in _COVERED.values())


@query(f"""
WITH c AS (SELECT c_custkey, {_COUNT} AS covered FROM customer), q AS (SELECT quantile_cont(covered, 0.5) AS m FROM c) SELECT c_custkey, covered, CAST(covered < m AS INTEGER) AS thin FROM c, q
""")
def coverage_routing(spark, d):
    return cohorts.thin(_sparse(spark, d), ["a", "b", "c", "e"]).select("c_custkey", "covered", "thin")


@query(f"""
WITH c AS (SELECT c_custkey, {_COUNT} AS n FROM customer), q AS (SELECT quantile_cont(n, 0.05) AS a, quantile_cont(n, 0.95) AS z FROM c WHERE c_custkey % 2 = 0)
SELECT c_custkey, round(least(greatest((n - a) / nullif(z - a, 0), 0), 1), 6) AS coverage FROM c, q
""")
def normalised_coverage(spark, d):
    df = _sparse(spark, d)
    names = [c for c in cohorts.with_prefix(df, "a", "b", "c", "e") if c != "c_custkey"]
    return cohorts.normalised_coverage(df, names, F.col("c_custkey") % 2 == 0).select("c_custkey", r6(F.col("coverage")).alias("coverage"))


@query("SELECT l_orderkey, l_linenumber, round(avg(l_extendedprice) OVER (PARTITION BY l_quantity, l_discount, l_tax, l_returnflag) + 1.37e-5, 4) AS prediction FROM lineitem")
def equal_inputs_agree(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    return lines.select("l_orderkey", "l_linenumber", off_grid(cohorts.one_prediction(F.col("l_extendedprice"), ["l_quantity", "l_discount", "l_tax", "l_returnflag"])).alias("prediction"))


_SEASONS = """
WITH s AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2), n AS (SELECT o_custkey, v, y, y - min(y) OVER (PARTITION BY o_custkey) + 1 AS k FROM s)
"""


def _seasons(spark, d):
    s = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice").groupBy("o_custkey", _year("o_orderdate")).agg(F.sum("o_totalprice").alias("v"))
    first = s.groupBy(F.col("o_custkey").alias("c")).agg(F.min("y").alias("f"))
    return s.join(first, F.col("o_custkey") == F.col("c")).select("o_custkey", "v", "y", (F.col("y") - F.col("f") + 1).alias("k"))


@query(_SEASONS + """
, t AS (SELECT o_custkey, sum(v) AS top2 FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY v DESC) <= 2) GROUP BY 1)
SELECT n.o_custkey, round(coalesce(sum(v) FILTER (k <= 5), 0) + 1.37e-5, 4) AS uniform, round(coalesce(sum(v) FILTER (k <= 3), 0) + 1.37e-5, 4) AS cum3,
  round(coalesce(sum(v * CASE k WHEN 1 THEN 1.0 WHEN 2 THEN 0.85 WHEN 3 THEN 0.7225 WHEN 4 THEN 0.614125 WHEN 5 THEN 0.52200625 END) FILTER (k <= 5), 0) + 1.37e-5, 4) AS disc85, round(max(top2) + 1.37e-5, 4) AS top2
FROM n JOIN t ON n.o_custkey = t.o_custkey GROUP BY 1
""")
def horizon_labels(spark, d):
    s = _seasons(spark, d)
    labels = cohorts.horizon_labels(s, "o_custkey", "k", "v", {"uniform": [1.0] * 5, "cum3": [1.0] * 3, "disc85": [0.85**k for k in range(5)]})
    top = cohorts.top_seasons(s, "o_custkey", "v").withColumnRenamed("o_custkey", "t")
    return labels.join(top, F.col("o_custkey") == F.col("t")).select("o_custkey", *[off_grid(F.col(c)).alias(c) for c in ("uniform", "cum3", "disc85")], off_grid(F.col("top")).alias("top2"))


@query(_SEASONS + "SELECT test_year, count(*) AS n, count(DISTINCT o_custkey) AS keys FROM (SELECT o_custkey, y, y - k + 1 AS c FROM n) JOIN range(1995, 2001) t(test_year) ON c <= test_year - 2 AND y <= test_year - 1 GROUP BY 1")
def walk_forward_folds(spark, d):
    rows = _seasons(spark, d).withColumn("c", F.col("y") - F.col("k") + 1)
    folds = cohorts.walk_forward(rows, spark.range(1995, 2001).withColumnRenamed("id", "test_year"), "c", "y")
    return folds.groupBy("test_year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("keys"))


@query(_SEASONS + "SELECT o_custkey, round(coalesce(sum(v) FILTER (k <= 3), 0) + 1.37e-5, 4) AS full, CASE WHEN count(*) FILTER (k <= 3) = 3 THEN round(sum(v) FILTER (k <= 3) + 1.37e-5, 4) END AS complete FROM n GROUP BY 1")
def season_truth(spark, d):
    return cohorts.truth(_seasons(spark, d), "o_custkey", "k", "v", [1, 2, 3]).select("o_custkey", off_grid(F.col("full")).alias("full"), off_grid(F.col("complete")).alias("complete"))


@query("SELECT p_partkey, q, row_number() OVER (ORDER BY q DESC, p_partkey) AS place FROM (SELECT l_partkey AS p_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ORDER BY q DESC, p_partkey LIMIT 100")
def most_important(spark, d):
    q = table(spark, d, "lineitem", "l_partkey", "l_quantity").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("q"))
    return cohorts.most_important(q, "p_partkey", "q").withColumn("place", F.col("place").cast("long"))


@query("""
WITH c AS (SELECT abs(corr(l_extendedprice, l_quantity)) AS pq, abs(corr(l_extendedprice, l_tax)) AS pt, abs(corr(l_quantity, l_tax)) AS qt, abs(corr(l_extendedprice, l_discount)) AS pd, abs(corr(l_quantity, l_discount)) AS qd, abs(corr(l_tax, l_discount)) AS td FROM lineitem),
a AS (SELECT *, pq < 0.9 AS q FROM c), b AS (SELECT *, pt < 0.9 AND (NOT q OR qt < 0.9) AS t FROM a), e AS (SELECT *, pd < 0.9 AND (NOT q OR qd < 0.9) AND (NOT t OR td < 0.9) AS d FROM b)
SELECT 'l_extendedprice' AS name FROM e UNION ALL SELECT 'l_quantity' FROM e WHERE q UNION ALL SELECT 'l_tax' FROM e WHERE t UNION ALL SELECT 'l_discount' FROM e WHERE d
""")
def decorrelated_columns(spark, d):
    names = ["l_extendedprice", "l_quantity", "l_tax", "l_discount"]
    taken = cohorts.decorrelated(table(spark, d, "lineitem", *names), names)
    return spark.createDataFrame([(c,) for c in taken], "name string")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity AS rank FROM lineitem WHERE l_quantity BETWEEN 1 AND 30 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1
""")
def clean_ranks(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_extendedprice").withColumnRenamed("l_quantity", "rank")
    return cohorts.clean_ranks(lines, ["l_orderkey"], "rank", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], (1, 30)).select("l_orderkey", "l_linenumber", "rank")
