"""Named queries and the SQL that an independent engine runs on the same tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import fits, matching, panel, quality, values
from ..sources import markup, table
from .registry import QUERIES, SQL, off_grid, query, r6

def _revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query("""
WITH r AS (SELECT o_custkey AS custkey, year(o_orderdate) AS y, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
n AS (SELECT r.*, c_nationkey AS nation FROM r JOIN customer ON custkey = c_custkey)
SELECT custkey, y, round(revenue + 1.37e-5, 4) AS revenue, round((sum(revenue) OVER g - revenue) / (count(*) OVER g - 1) + 1.37e-5, 4) AS peer_mean,
  round((rank() OVER (PARTITION BY nation, y ORDER BY revenue) + (count(*) OVER (PARTITION BY nation, y, revenue) - 1) / 2.0::DOUBLE) / count(*) OVER g, 6) AS percentile
FROM n WINDOW g AS (PARTITION BY nation, y) QUALIFY count(*) OVER g > 3
""")
def q01_loo_peer_rate(spark, d):
    orders = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, d, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
    rev = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y")).agg(F.sum(_revenue()).alias("revenue"))
    n = rev.join(table(spark, d, "customer", "c_custkey", "c_nationkey"), F.col("custkey") == F.col("c_custkey"))
    g = Window.partitionBy("c_nationkey", "y")
    return n.select("custkey", "y", off_grid(F.col("revenue")).alias("revenue"), off_grid(panel.leave_one_out_mean(F.col("revenue"), g)).alias("peer_mean"), r6(panel.percent_rank(F.col("revenue"), "c_nationkey", "y")).alias("percentile"), F.count(F.lit(1)).over(g).alias("_n")).where("_n > 3").drop("_n")


@query("""
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  CASE WHEN try_cast(json_extract_string(props, '$.k') AS DOUBLE) > 0 THEN value / try_cast(json_extract_string(props, '$.k') AS DOUBLE) END AS per_k,
  CASE WHEN value < 10 THEN 10.0 WHEN value > 60 THEN 60.0 ELSE value END AS clipped, CASE WHEN value BETWEEN 5 AND 50 THEN value END AS gated FROM events
""")
def cast_guarded(spark, d):
    k = values.number(F.get_json_object("props", "$.k"))
    return table(spark, d, "events", "event_id", "value", "props").select("event_id", k.alias("k"), values.ratio(F.col("value"), k).alias("per_k"), values.clip(F.col("value"), 10.0, 60.0).alias("clipped"), values.in_range(F.col("value"), 5, 50).alias("gated"))


@query("""
SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'BRASS|COPPER') THEN 'warm' WHEN regexp_matches(p_type, 'STEEL|NICKEL|TIN') THEN 'cool' ELSE 'other' END AS metal,
  CASE p_brand WHEN 'Brand#11' THEN 1 WHEN 'Brand#12' THEN 2 END AS brand_code FROM part
""")
def codes_first_hit(spark, d):
    code = F.create_map(*[F.lit(x) for p in (("Brand#11", 1), ("Brand#12", 2)) for x in p])
    return table(spark, d, "part", "p_partkey", "p_type", "p_brand").select("p_partkey", values.first_rule(F.col("p_type"), [("BRASS|COPPER", "warm"), ("STEEL|NICKEL|TIN", "cool")], "other").alias("metal"), F.try_element_at(code, F.col("p_brand")).alias("brand_code"))


@query("""
WITH a AS (SELECT l_partkey, avg(l_extendedprice) AS paid FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT p_partkey, round(coalesce(paid, p_retailprice), 6) AS price, CASE WHEN paid IS NOT NULL THEN 2 WHEN p_retailprice IS NOT NULL THEN 1 END AS price_src FROM part LEFT JOIN a ON p_partkey = l_partkey
""")
def coalesce_src(spark, d):
    paid = table(spark, d, "lineitem", "l_partkey", "l_extendedprice", "l_returnflag").where("l_returnflag = 'R'").groupBy("l_partkey").agg(F.avg("l_extendedprice").alias("paid"))
    value, source = values.with_source((F.col("paid"), 2), (F.col("p_retailprice"), 1))
    return table(spark, d, "part", "p_partkey", "p_retailprice").join(paid, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", r6(value).alias("price"), source.alias("price_src"))


@query("""
SELECT 'o_custkey' AS name, count(o_custkey) AS observed, count(DISTINCT o_custkey) AS uniques FROM orders UNION ALL
SELECT 'o_totalprice', count(o_totalprice), count(DISTINCT o_totalprice) FROM orders UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), count(DISTINCT o_orderstatus) FROM orders
""")
def coverage_eligibility(spark, d):
    cols = ["o_custkey", "o_totalprice", "o_orderstatus"]
    one = table(spark, d, "orders", *cols).agg(*[F.struct(F.lit(c).alias("name"), F.count(c).alias("observed"), F.count_distinct(c).alias("uniques")).alias(c) for c in cols])
    return one.select(F.explode(F.array(*cols)).alias("x")).select("x.*")


@query("SELECT p_partkey, p_size * p_retailprice AS size_price, CASE WHEN p_size >= 25 AND p_retailprice > 1000 THEN 1 ELSE 0 END AS large_dear FROM part")
def interaction_features(spark, d):
    return table(spark, d, "part", "p_partkey", "p_size", "p_retailprice").select("p_partkey", (F.col("p_size") * F.col("p_retailprice")).alias("size_price"), F.when((F.col("p_size") >= 25) & (F.col("p_retailprice") > 1000), 1).otherwise(0).alias("large_dear"))


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def join_left_m1(spark, d):
    customers = quality.unique_or_fail(table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey"), ["c_custkey"])
    nations = quality.unique_or_fail(table(spark, d, "nation", "n_nationkey", "n_name"), ["n_nationkey"])
    return table(spark, d, "orders", "o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("""
WITH a AS (SELECT o_custkey AS k, count(*) AS n_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n_done FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, n_open, n_done FROM a FULL JOIN b ON a.k = b.k
""")
def join_full_outer(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_orderstatus").withColumnRenamed("o_custkey", "k")
    return o.where("o_orderstatus = 'O'").groupBy("k").agg(F.count(F.lit(1)).alias("n_open")).join(o.where("o_orderstatus = 'F'").groupBy("k").agg(F.count(F.lit(1)).alias("n_done")), "k", "full")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def join_semi(spark, d):
    big = table(spark, d, "orders", "o_custkey", "o_totalprice").where("o_totalprice > 200000")
    return table(spark, d, "customer", "c_custkey").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative balance' ELSE 'no order' END AS reason FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti_reason(spark, d):
    return table(spark, d, "customer", "c_custkey", "c_acctbal").join(table(spark, d, "orders", "o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", F.when(F.col("c_acctbal") < 0, "negative balance").otherwise("no order").alias("reason"))


@query("""
WITH c AS (SELECT DISTINCT user_id, TIMESTAMP '2024-01-15' + to_days(CAST(user_id % 10 AS INTEGER)) AS cutoff FROM events),
f AS (SELECT c.user_id, cutoff, event_id, event_type, value, row_number() OVER (PARTITION BY c.user_id ORDER BY ts DESC, event_id DESC) AS r FROM c JOIN events e ON e.user_id = c.user_id AND ts < cutoff AND date_diff('day', ts::DATE, cutoff::DATE) <= 7)
SELECT c.user_id, event_id, event_type, value FROM c LEFT JOIN f ON c.user_id = f.user_id AND r = 1
""")
def asof_backward(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_id", "event_type", "value")
    cuts = e.select("user_id").distinct().withColumn("cutoff", F.expr("timestamp_ntz'2024-01-15 00:00:00' + make_dt_interval(cast(user_id % 10 as int))"))
    return panel.as_of(e, cuts, ["user_id"], "ts", "cutoff", 7, "event_id").select("user_id", "event_id", "event_type", "value")


@query("""
WITH h AS (SELECT user_id, value, event_id, ts, date_diff('day', ts::DATE, DATE '2024-01-31') AS days FROM events)
SELECT user_id, value AS at_horizon, days FROM h WHERE days BETWEEN 10 AND 20 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def asof_horizon(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_id", "value").withColumn("days", F.datediff(F.lit("2024-01-31").cast("date"), F.col("ts").cast("date")))
    return e.where("days BETWEEN 10 AND 20").groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "value", "days")).alias("m")).select("user_id", F.col("m.value").alias("at_horizon"), F.col("m.days").cast("long").alias("days"))


@query("""
WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders)
SELECT a.o_custkey AS custkey, a.y AS ref_year, max(b.y) AS class_year FROM y a JOIN y b ON a.o_custkey = b.o_custkey AND b.y < a.y AND a.y <= b.y + 2 GROUP BY ALL
""")
def range_class_match(spark, d):
    y = table(spark, d, "orders", "o_custkey", "o_orderdate").select("o_custkey", F.year("o_orderdate").alias("y")).distinct()
    a, b = y.select("o_custkey", F.col("y").alias("ref_year")), y.select("o_custkey", F.col("y").alias("class_year"))
    return a.join(b, "o_custkey").where("class_year < ref_year AND ref_year <= class_year + 2").groupBy(F.col("o_custkey").alias("custkey"), "ref_year").agg(F.max("class_year").alias("class_year"))


@query("""
WITH s AS (SELECT o_custkey AS custkey, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1)
SELECT custkey, CASE WHEN DATE '1997-01-01' BETWEEN a AND b THEN 'active' WHEN b < DATE '1997-01-01' THEN 'ended' ELSE 'later' END AS status FROM s
""")
def interval_active(spark, d):
    at = F.lit("1997-01-01").cast("date")
    s = table(spark, d, "orders", "o_custkey", "o_orderdate").groupBy(F.col("o_custkey").alias("custkey")).agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return s.select("custkey", F.when(at.between(F.col("a"), F.col("b")), "active").when(F.col("b") < at, "ended").otherwise("later").alias("status"))


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey AND abs(a.p_retailprice - b.p_retailprice) <= 5")
def tolerance_join(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    a, b = p.alias("a"), p.alias("b")
    return a.join(b, (F.col("a.p_brand") == F.col("b.p_brand")) & (F.col("a.p_size") == F.col("b.p_size"))).where("a.p_partkey < b.p_partkey AND abs(a.p_retailprice - b.p_retailprice) <= 5").select(F.col("a.p_partkey").alias("a"), F.col("b.p_partkey").alias("b"))


@query("""
WITH y AS (SELECT o_custkey AS custkey, year(o_orderdate) AS y, sum(o_totalprice) AS s FROM orders GROUP BY ALL), l AS (SELECT *, lag(y) OVER w AS py, lag(s) OVER w AS ps FROM y WINDOW w AS (PARTITION BY custkey ORDER BY y))
SELECT custkey, y, CASE WHEN py = y - 1 THEN round(s - ps, 6) END AS delta, round((s - ps) / (y - py), 6) AS per_year FROM l
""")
def period_self_join(spark, d):
    y = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice").groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y")).agg(F.sum("o_totalprice").alias("s"))
    w = Window.partitionBy("custkey").orderBy("y")
    diff = F.col("s") - F.lag("s").over(w)
    return y.select("custkey", "y", F.when(F.lag("y").over(w) == F.col("y") - 1, r6(diff)).alias("delta"), r6(diff / (F.col("y") - F.lag("y").over(w))).alias("per_year"))


@query("SELECT a.l_orderkey AS orderkey, a.l_linenumber AS line, b.l_linenumber AS other FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber <> b.l_linenumber WHERE a.l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) = 2)")
def opponent_self_join(spark, d):
    x = table(spark, d, "lineitem", "l_orderkey", "l_linenumber").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))).where("n = 2").drop("n")
    return x.join(x.withColumnRenamed("l_linenumber", "other"), "l_orderkey").where("l_linenumber <> other").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"), "other")


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey, round(s_acctbal / 100) AS b FROM supplier), c AS (SELECT c_custkey, c_nationkey, round(c_acctbal / 100) AS b FROM customer),
j AS (SELECT s_suppkey, c_custkey FROM s JOIN c ON s_nationkey = c_nationkey AND s.b = c.b)
SELECT * FROM j QUALIFY count(*) OVER (PARTITION BY s_suppkey) = 1 AND count(*) OVER (PARTITION BY c_custkey) = 1
""")
def mutual_unique_join(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_acctbal").select("s_suppkey", F.col("s_nationkey").alias("k"), F.round(F.col("s_acctbal") / 100).alias("b"))
    c = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal").select("c_custkey", F.col("c_nationkey").alias("k"), F.round(F.col("c_acctbal") / 100).alias("b"))
    j = s.join(c, ["k", "b"]).select("s_suppkey", "c_custkey").withColumn("x", F.count(F.lit(1)).over(Window.partitionBy("s_suppkey"))).withColumn("y", F.count(F.lit(1)).over(Window.partitionBy("c_custkey")))
    return j.where("x = 1 AND y = 1").select("s_suppkey", "c_custkey")


@query("SELECT l_suppkey, round(40 * sum(l_discount * l_extendedprice) / sum(l_extendedprice), 6) AS per_40, round(sum(l_quantity * l_tax) / sum(l_quantity), 6) AS wmean_tax, round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_returned FROM lineitem GROUP BY 1")
def rates_of_sums(spark, d):
    x = table(spark, d, "lineitem", "l_suppkey", "l_discount", "l_extendedprice", "l_quantity", "l_tax", "l_returnflag")
    return x.groupBy("l_suppkey").agg(r6(panel.rate(F.col("l_discount") * F.col("l_extendedprice"), F.col("l_extendedprice"), 40)).alias("per_40"), r6(panel.weighted_mean(F.col("l_tax"), F.col("l_quantity"))).alias("wmean_tax"), r6(F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))).alias("share_returned"))


@query("""
WITH m AS (SELECT *, sum(l_quantity * l_extendedprice) OVER g / sum(l_quantity) OVER g AS mean FROM lineitem WINDOW g AS (PARTITION BY l_suppkey))
SELECT l_suppkey, round(sqrt(sum(l_quantity * power(l_extendedprice - mean, 2)) / sum(l_quantity)), 6) AS wsd FROM m GROUP BY 1
""")
def weighted_sd(spark, d):
    """One pass: moments about a fixed value near the prices, as squares of the prices themselves would cancel."""
    q, x = F.col("l_quantity"), F.col("l_extendedprice") - 40_000
    mean = F.sum(q * x) / F.sum(q)
    return table(spark, d, "lineitem", "l_suppkey", "l_quantity", "l_extendedprice").groupBy("l_suppkey").agg(r6(F.sqrt(F.greatest(F.sum(q * x * x) / F.sum(q) - mean * mean, F.lit(0.0)))).alias("wsd"))


@query("""
WITH s AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_partkey, round(q / sum(q) OVER g, 6) AS share, round(sum(q * q) OVER g / power(sum(q) OVER g, 2), 6) AS hhi, round(CASE WHEN count(*) OVER g > 1 THEN (sum(q) OVER g - q) / (count(*) OVER g - 1) END, 6) AS loo FROM s WINDOW g AS (PARTITION BY l_suppkey)
""")
def loo_share_hhi(spark, d):
    s = table(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_quantity").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"))
    g, q = Window.partitionBy("l_suppkey"), F.col("q")
    return s.select("l_suppkey", "l_partkey", r6(panel.share(q, g)).alias("share"), r6(F.sum(q * q).over(g) / F.pow(F.sum(q).over(g), F.lit(2))).alias("hhi"), r6(panel.leave_one_out_mean(q, g)).alias("loo"))


@query("""
WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice AS v, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem),
t AS (SELECT l_suppkey, max(v) FILTER (k = 1) AS v_0, max(v) FILTER (k = 2) AS v_1, max(v) FILTER (k = 3) AS v_2 FROM r WHERE k <= 3 GROUP BY 1)
SELECT r.l_suppkey, r.l_orderkey, r.l_linenumber, v_0, v_1, v_2, CASE WHEN k = 1 THEN v_1 ELSE v_0 END AS best_other FROM r JOIN t USING (l_suppkey) WHERE k <= 3
""")
def topk_wide(spark, d):
    """Tasks keep three rows a supplier before the shuffle; what is wide then comes from the three."""
    g = Window.partitionBy("l_suppkey")
    w = g.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    top = table(spark, d, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice").withColumn("k", F.row_number().over(w)).where("k <= 3")
    top = top.withColumns({f"v_{i}": F.max(F.when(F.col("k") == i + 1, F.col("l_extendedprice"))).over(g) for i in range(3)})
    return top.select("l_suppkey", "l_orderkey", "l_linenumber", "v_0", "v_1", "v_2", F.when(F.col("k") == 1, F.col("v_1")).otherwise(F.col("v_0")).alias("best_other"))


@query("""
WITH n AS (SELECT c_nationkey, avg(c_acctbal) AS m, count(*) AS w FROM customer GROUP BY 1)
SELECT n_regionkey AS region, round(sum(m * w) / sum(w), 6) AS mean, sum(w)::BIGINT AS n FROM n JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def two_level_mean(spark, d):
    n = table(spark, d, "customer", "c_nationkey", "c_acctbal").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("m"), F.count(F.lit(1)).alias("w"))
    return n.join(table(spark, d, "nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("region")).agg(r6(panel.weighted_mean(F.col("m"), F.col("w").cast("double"))).alias("mean"), F.sum("w").alias("n"))


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY ALL)
SELECT user_id, event_type AS mode, n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first_id) = 1
""")
def mode_tie(spark, d):
    c = table(spark, d, "events", "user_id", "event_type", "event_id").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))
    return c.groupBy("user_id").agg(F.max_by(F.struct("event_type", "n"), F.struct("n", -F.col("first_id"))).alias("m")).select("user_id", F.col("m.event_type").alias("mode"), F.col("m.n").alias("n"))


@query("SELECT l_suppkey, round(stddev_samp(l_quantity), 6) AS sd, round(CASE WHEN count(*) >= 3 THEN skewness(l_quantity) END, 5) AS skew, round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS cv FROM lineitem GROUP BY 1")
def moments_skew(spark, d):
    n = F.count("l_quantity").cast("double")
    # Spark's skewness is the population's; the correction makes it the sample's.
    skew = F.when(n >= 3, F.skewness("l_quantity") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    return table(spark, d, "lineitem", "l_suppkey", "l_quantity").groupBy("l_suppkey").agg(r6(F.stddev_samp("l_quantity")).alias("sd"), F.round(skew, 5).alias("skew"), r6(F.stddev_samp("l_quantity") / F.avg("l_quantity")).alias("cv"))


@query("SELECT user_id, round(stddev_pop(value), 6) AS pop_sd, CASE WHEN count(value) >= 2 THEN round(stddev_samp(value), 6) END AS samp_sd, CASE WHEN count(value) >= 2 THEN max(value) - min(value) END AS spread, count(DISTINCT event_type) AS sources FROM events GROUP BY 1")
def service_spread(spark, d):
    two = F.count("value") >= 2
    return table(spark, d, "events", "user_id", "value", "event_type").groupBy("user_id").agg(r6(F.stddev_pop("value")).alias("pop_sd"), F.when(two, r6(F.stddev_samp("value"))).alias("samp_sd"), F.when(two, F.max("value") - F.min("value")).alias("spread"), F.count_distinct("event_type").alias("sources"))


@query("SELECT o_orderpriority AS priority, round(median(o_totalprice), 6) AS med, round(quantile_cont(o_totalprice, 0.05), 6) AS q05, round(quantile_cont(o_totalprice, 0.95), 6) AS q95, count(*) FILTER (o_totalprice < 50000) AS low, count(*) FILTER (o_totalprice >= 50000) AS high FROM orders GROUP BY 1")
def quantiles(spark, d):
    p = F.col("o_totalprice")
    return table(spark, d, "orders", "o_orderpriority", "o_totalprice").groupBy(F.col("o_orderpriority").alias("priority")).agg(r6(F.median(p)).alias("med"), r6(F.percentile(p, 0.05)).alias("q05"), r6(F.percentile(p, 0.95)).alias("q95"), F.count(F.when(p < 50000, 1)).alias("low"), F.count(F.when(p >= 50000, 1)).alias("high"))


@query("SELECT c_nationkey, CAST(sum(('0x' || substr(md5(c_mktsegment || ':' || c_custkey), 1, 15))::BIGINT) AS VARCHAR) AS multiset FROM customer GROUP BY 1")
def multiset_hash(spark, d):
    """A digest of a group's members in any order: the sum of 60 bits of each one's hash, so partial sums meet, not members."""
    head = F.conv(F.substring(F.md5(F.concat_ws(":", "c_mktsegment", "c_custkey")), 1, 15), 16, 10).cast("decimal(20,0)")
    return table(spark, d, "customer", "c_nationkey", "c_mktsegment", "c_custkey").groupBy("c_nationkey").agg(F.sum(head).cast("string").alias("multiset"))


@query("""
WITH y AS (SELECT o_custkey AS custkey, year(o_orderdate) AS y, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY ALL)
SELECT custkey, y, coalesce(sum(n) OVER w, 0)::BIGINT AS past_n, round(avg(m) OVER w, 6) AS past_mean FROM y WINDOW w AS (PARTITION BY custkey ORDER BY y RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
""")
def history_lagged(spark, d):
    y = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice").groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("m"))
    w = Window.partitionBy("custkey").orderBy("y").rangeBetween(Window.unboundedPreceding, -2)
    return y.select("custkey", "y", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("past_n"), r6(F.avg("m").over(w)).alias("past_mean"))


@query("SELECT o_custkey AS custkey, max(year(o_orderdate)) - min(year(o_orderdate)) + 1 AS span, max(year(o_orderdate)) - min(year(o_orderdate)) + 1 - count(DISTINCT year(o_orderdate)) AS missing FROM orders GROUP BY 1")
def career_gaps(spark, d):
    y = F.year("o_orderdate")
    span = F.max(y) - F.min(y) + 1
    return table(spark, d, "orders", "o_custkey", "o_orderdate").groupBy(F.col("o_custkey").alias("custkey")).agg(span.cast("long").alias("span"), (span - F.count_distinct(y)).alias("missing"))


@query("""
WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS x FROM part)
SELECT p_partkey, CASE WHEN x IS NOT NULL THEN round((rank() OVER (PARTITION BY p_brand ORDER BY x NULLS LAST) + (count(*) OVER (PARTITION BY p_brand, x) - 1) / 2.0::DOUBLE) / count(x) OVER (PARTITION BY p_brand), 6) END AS pct,
  CASE WHEN x IS NOT NULL AND count(x) OVER (PARTITION BY p_brand) > 1 THEN round((rank() OVER (PARTITION BY p_brand ORDER BY x NULLS LAST) - 1)::DOUBLE / (count(x) OVER (PARTITION BY p_brand) - 1), 6) END AS strict FROM p
""")
def pct_rank_avg(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_brand", "p_size").withColumn("x", F.when(F.col("p_size") % 7 != 0, F.col("p_size")))
    n = F.count("x").over(Window.partitionBy("p_brand"))
    rank = F.rank().over(Window.partitionBy("p_brand").orderBy(F.asc_nulls_last("x")))
    return p.select("p_partkey", r6(panel.percent_rank(F.col("x"), "p_brand")).alias("pct"), F.when(F.col("x").isNotNull() & (n > 1), r6((rank - 1) / F.nullif(n - 1, F.lit(0).cast("long")))).alias("strict"))


@query("""
WITH b AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY p_brand ORDER BY p_size) - n AS below, sum(n) OVER (PARTITION BY p_brand) AS total FROM b)
SELECT p_partkey, round((below + 0.5::DOUBLE * n) / total, 6) AS mid FROM part JOIN r USING (p_brand, p_size) WHERE total >= 20
""")
def pct_midrank_ref(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_brand", "p_size")
    b = p.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    g = Window.partitionBy("p_brand")
    ref = b.withColumn("below", F.sum("n").over(g.orderBy("p_size")) - F.col("n")).withColumn("total", F.sum("n").over(g))
    return p.join(ref, ["p_brand", "p_size"]).where("total >= 20").select("p_partkey", r6((F.col("below") + 0.5 * F.col("n")) / F.col("total")).alias("mid"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, max(value) OVER (PARTITION BY user_id) AS top FROM events)
SELECT user_id, max(value) FILTER (k = 1) AS last, max(value) FILTER (k = 2) AS prev, round(max(value) FILTER (k = 1) - 2 * max(value) FILTER (k = 2) + max(value) FILTER (k = 3), 6) AS accel, max(CASE WHEN k = 1 AND value = top THEN 1 ELSE 0 END) AS is_peak FROM r GROUP BY 1
""")
def nth_last_accel(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_id", "value")
    r = e.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))).withColumn("top", F.max("value").over(Window.partitionBy("user_id")))
    v = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    return r.groupBy("user_id").agg(v(1).alias("last"), v(2).alias("prev"), r6(v(1) - 2 * v(2) + v(3)).alias("accel"), F.max(F.when((F.col("k") == 1) & (F.col("value") == F.col("top")), 1).otherwise(0)).alias("is_peak"))


@query("""
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, round(avg(value) FILTER (k <= 10) - avg(value), 6) AS last10_diff, round(avg(value) FILTER (2 * k <= n) - avg(value) FILTER (2 * k > n), 6) AS late_early FROM r GROUP BY 1
""")
def lastn_vs_all(spark, d):
    w = Window.partitionBy("user_id")
    r = table(spark, d, "events", "user_id", "ts", "event_id", "value").withColumn("k", F.row_number().over(w.orderBy(F.desc("ts"), F.desc("event_id")))).withColumn("n", F.count(F.lit(1)).over(w))
    mean = lambda c: F.avg(F.when(c, F.col("value")))
    return r.groupBy("user_id").agg(r6(mean(F.col("k") <= 10) - F.avg("value")).alias("last10_diff"), r6(mean(2 * F.col("k") <= F.col("n")) - mean(2 * F.col("k") > F.col("n"))).alias("late_early"))


@query("""
WITH a AS (SELECT *, date_diff('day', ts::DATE, DATE '2024-01-31') AS ago FROM events)
SELECT user_id, count(*) FILTER (ago <= 7) AS n_7, count(*) FILTER (ago <= 14) AS n_14, count(DISTINCT event_type) FILTER (ago <= 14) AS kinds_14 FROM a GROUP BY 1
""")
def countback_windows(spark, d):
    a = table(spark, d, "events", "user_id", "ts", "event_type").withColumn("ago", F.datediff(F.lit("2024-01-31").cast("date"), F.col("ts").cast("date")))
    return a.groupBy("user_id").agg(F.count(F.when(F.col("ago") <= 7, 1)).alias("n_7"), F.count(F.when(F.col("ago") <= 14, 1)).alias("n_14"), F.count_distinct(F.when(F.col("ago") <= 14, F.col("event_type"))).alias("kinds_14"))


@query("""
WITH s AS (SELECT DISTINCT user_id, ts::DATE AS d FROM events WHERE event_type = 'click' OR value > 30), i AS (SELECT *, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS g FROM s)
SELECT user_id, CAST(min(d) AS VARCHAR) AS first, CAST(max(d) AS VARCHAR) AS last, count(*) AS days FROM i GROUP BY user_id, g HAVING count(*) >= 2
""")
def absence_islands(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_type", "value").where("event_type = 'click' OR value > 30").select("user_id", F.col("ts").cast("date").alias("d"))
    return panel.islands(e, "user_id", "d").where("days >= 2").select("user_id", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), "days")


@query("""
WITH s AS (SELECT user_id, ts::DATE AS d, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS state FROM events GROUP BY ALL)
SELECT user_id, state, CAST(min(d) AS VARCHAR) AS first_day, count(*) AS days FROM s GROUP BY ALL
""")
def dedupe_states(spark, d):
    s = table(spark, d, "events", "user_id", "ts", "event_type").groupBy("user_id", F.col("ts").cast("date").alias("d")).agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("state"))
    return s.groupBy("user_id", "state").agg(F.min("d").cast("string").alias("first_day"), F.count(F.lit(1)).alias("days"))


@query("SELECT custkey, y, row_number() OVER (PARTITION BY custkey ORDER BY y) AS ordinal FROM (SELECT DISTINCT o_custkey AS custkey, year(o_orderdate) AS y FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01')")
def season_ordinal(spark, d):
    y = table(spark, d, "orders", "o_custkey", "o_orderdate").where(F.col("o_orderdate") < F.expr("timestamp_ntz'1999-07-01 00:00:00'")).select(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("y")).distinct()
    return y.withColumn("ordinal", F.row_number().over(Window.partitionBy("custkey").orderBy("y")))


@query("SELECT o_orderkey, CASE WHEN stddev_samp(o_totalprice) OVER g > 1e-9 THEN round((o_totalprice - avg(o_totalprice) OVER g) / stddev_samp(o_totalprice) OVER g, 6) END AS z FROM orders WINDOW g AS (PARTITION BY o_orderpriority, year(o_orderdate))")
def cohort_z(spark, d):
    g = Window.partitionBy("o_orderpriority", F.year("o_orderdate"))
    sd = F.stddev_samp("o_totalprice").over(g)
    return table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice").select("o_orderkey", F.when(sd > 1e-9, r6((F.col("o_totalprice") - F.avg("o_totalprice").over(g)) / sd)).alias("z"))


_GAUSS = values.inverse_normal_sql("q")


@query(f"""
WITH p AS (SELECT p_partkey, (rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_brand, p_retailprice) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY p_brand) AS pct FROM part),
c AS (SELECT p_partkey, CASE WHEN pct < 0.01 THEN 0.01::DOUBLE WHEN pct > 0.99 THEN 0.99::DOUBLE ELSE pct END AS q FROM p) SELECT p_partkey, round({_GAUSS}, 6) AS g FROM c
""")
def gauss_rank(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_brand", "p_retailprice").withColumn("q", values.clip(panel.percent_rank(F.col("p_retailprice"), "p_brand"), 0.01, 0.99))
    return p.select("p_partkey", r6(F.expr(_GAUSS)).alias("g"))


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_user_chars FROM conversations")
def carry_forward(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    n = F.when(F.col("role") == "user", F.char_length("text").cast("long"))
    return table(spark, d, "conversations", "conv_id", "turn", "role", "text").select("conv_id", "turn", F.last(n, ignorenulls=True).over(w).alias("last_user_chars"))


@query("""
WITH l AS (SELECT user_id, ts::DATE AS d, event_type FROM events WHERE ts < TIMESTAMP '2024-01-20' QUALIFY ts::DATE = max(ts::DATE) OVER (PARTITION BY user_id))
SELECT user_id, CAST(max(d) AS VARCHAR) AS as_of, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) END AS status, CASE WHEN count(DISTINCT event_type) > 1 THEN 1 ELSE 0 END AS conflict FROM l GROUP BY 1
""")
def status_asof_conflict(spark, d):
    e = table(spark, d, "events", "user_id", "ts", "event_type").where(F.col("ts") < F.expr("timestamp_ntz'2024-01-20 00:00:00'")).withColumn("d", F.col("ts").cast("date"))
    kinds = e.groupBy("user_id", "d").agg(F.count_distinct("event_type").alias("n"), F.min("event_type").alias("s"))
    return kinds.groupBy("user_id").agg(F.max(F.struct("d", "n", "s")).alias("m")).select("user_id", F.col("m.d").cast("string").alias("as_of"), F.when(F.col("m.n") == 1, F.col("m.s")).alias("status"), F.when(F.col("m.n") > 1, 1).otherwise(0).alias("conflict"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY sha256(c_name), c_name) AS place, list_sum(list_transform(string_split(sha256(c_name), ''), lambda x: ('0x' || x)::INTEGER))::BIGINT % 3 AS fold FROM customer")
def hash_order_fold(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name").withColumn("h", F.sha2("c_name", 256))
    c = panel.numbered(c, [F.col("h"), F.col("c_name")], F.substring("h", 1, 2), "place")
    return c.select("c_custkey", F.col("place").cast("long").alias("place"), values.fold_of(F.col("c_name")).cast("long").alias("fold"))


@query("""
WITH s AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000), c AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9000)
SELECT 'both' AS part, k FROM (SELECT k FROM s INTERSECT SELECT k FROM c) UNION ALL SELECT 'supplier only', k FROM (SELECT k FROM s EXCEPT SELECT k FROM c) UNION ALL SELECT 'any', k FROM (SELECT k FROM s UNION SELECT k FROM c)
""")
def set_ops(spark, d):
    s = table(spark, d, "supplier", "s_nationkey", "s_acctbal").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k")).distinct()
    c = table(spark, d, "customer", "c_nationkey", "c_acctbal").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).distinct()
    parts = {"both": s.intersect(c), "supplier only": s.exceptAll(c), "any": s.union(c).distinct()}
    out = None
    for name, df in parts.items():
        x = df.select(F.lit(name).alias("part"), "k")
        out = x if out is None else out.unionByName(x)
    return out


@query("""
WITH c AS (SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+')) AS words, len(regexp_extract_all(lower(text), '\\b(?:the|of|and)\\b')) AS pos, len(regexp_extract_all(lower(text), '\\b(?:idiot|moron|stupid)\\b')) AS neg FROM documents)
SELECT doc_id, words, pos, neg, round(CASE WHEN words > 0 THEN 1000.0::DOUBLE * pos / words END, 6) AS pos_1k, round((pos - neg)::DOUBLE / (pos + neg + 3), 6) AS tone FROM c
""")
def lexicon_rates(spark, d):
    low = F.lower("text")
    c = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.regexp_count("text", F.lit("[A-Za-z]+")).cast("long").alias("words"), F.regexp_count(low, F.lit(r"\b(?:the|of|and)\b")).cast("long").alias("pos"), F.regexp_count(low, F.lit(r"\b(?:idiot|moron|stupid)\b")).cast("long").alias("neg"))
    return c.select("*", r6(F.when(F.col("words") > 0, 1000.0 * F.col("pos") / F.nullif(F.col("words"), F.lit(0).cast("long")))).alias("pos_1k"), r6((F.col("pos") - F.col("neg")) / (F.col("pos") + F.col("neg") + 3)).alias("tone"))


SQL["lexicon_rates"] = SQL["lexicon_rates"].replace("\\\\b", "\\b")


@query("""
WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), c AS (SELECT doc_id, unnest(range(0, len(w) // 100)) AS i, w FROM w)
SELECT doc_id, round(avg(len(list_distinct(w[i * 100 + 1 : i * 100 + 100])) / 100.0::DOUBLE), 6) AS ttr, count(*) AS chunks FROM c GROUP BY 1
""")
def ttr_chunks(spark, d):
    w = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.split("text", " ").alias("w"))
    n = F.floor(F.size("w") / 100).cast("int")
    part = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.size(F.array_distinct(F.slice("w", i * 100 + 1, F.lit(100)))) / F.lit(100.0))
    return w.where(n > 0).select("doc_id", r6(F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / n).alias("ttr"), n.cast("long").alias("chunks"))


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS plain,
  list_transform(regexp_extract_all(html, '<li>.*?</li>'), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS items FROM pages
""")
def strip_markup(spark, d):
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]*>", " "), r"[ \t\r\n]+", " ")
    return table(spark, d, "pages", "page_id", "html").select("page_id", F.trim(plain).alias("plain"), F.transform(F.regexp_extract_all("html", F.lit("<li>.*?</li>"), 0), lambda x: F.regexp_replace(x, "<[^>]*>", "")).alias("items"))


@query("""
WITH y AS (SELECT o_custkey AS custkey, year(o_orderdate) - 1995 AS x, sum(o_totalprice) AS s, count(*)::DOUBLE AS w FROM orders GROUP BY ALL)
SELECT custkey, CASE WHEN count(*) >= 2 THEN round(regr_slope(s, x) + 1.37e-5, 4) END AS slope, CASE WHEN sum(w) * sum(w * x * x) - power(sum(w * x), 2) > 1e-9 THEN round((sum(w) * sum(w * x * s) - sum(w * x) * sum(w * s)) / (sum(w) * sum(w * x * x) - power(sum(w * x), 2)) + 1.37e-5, 4) END AS wslope FROM y GROUP BY 1
""")
def ols_slope(spark, d):
    y = table(spark, d, "orders", "o_custkey", "o_orderdate", "o_totalprice").groupBy(F.col("o_custkey").alias("custkey"), (F.year("o_orderdate") - 1995).cast("double").alias("x")).agg(F.sum("o_totalprice").alias("s"), F.count(F.lit(1)).cast("double").alias("w"))
    return y.groupBy("custkey").agg(F.when(F.count(F.lit(1)) >= 2, off_grid(F.regr_slope("s", "x"))).alias("slope"), off_grid(panel.weighted_slope(F.col("x"), F.col("s"), F.col("w"))).alias("wslope"))


@query("""
WITH m AS (SELECT year(o_orderdate) AS y, count(*)::DOUBLE AS n, sum(x) AS sx, sum(z) AS sz, sum(x * x) AS sxx, sum(x * z) AS sxz FROM (SELECT *, o_custkey % 100 / 10.0::DOUBLE AS x, o_totalprice / 1000 AS z FROM orders) GROUP BY 1),
e AS (SELECT y, sum(n) OVER w AS n, sum(sx) OVER w AS sx, sum(sz) OVER w AS sz, sum(sxx) OVER w AS sxx, sum(sxz) OVER w AS sxz FROM m WINDOW w AS (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT y, (n * sxz - sx * sz) / (n * sxx - sx * sx) AS b, (sz - (n * sxz - sx * sz) / (n * sxx - sx * sx) * sx) / n AS a FROM e WHERE n >= 500)
SELECT o_orderkey, round(o_totalprice / 1000 - a - b * (o_custkey % 100 / 10.0::DOUBLE), 5) AS resid FROM orders JOIN f ON year(o_orderdate) = y
""")
def expanding_fit(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").select("o_orderkey", F.year("o_orderdate").alias("y"), ((F.col("o_custkey") % 100) / 10.0).alias("x"), (F.col("o_totalprice") / 1000).alias("z"))
    m = o.groupBy("y").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("x").alias("sx"), F.sum("z").alias("sz"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("z")).alias("sxz"))
    w = panel.before(Window.orderBy("y"))  # one row a year: moments instead of a refit on all prior rows
    e = m.select("y", *[F.sum(c).over(w).alias(c) for c in ("n", "sx", "sz", "sxx", "sxz")]).where("n >= 500")
    f = e.withColumn("b", F.expr("(n * sxz - sx * sz) / (n * sxx - sx * sx)")).withColumn("a", F.expr("(sz - b * sx) / n")).select("y", "a", "b")
    return o.join(f, "y").select("o_orderkey", F.round(F.col("z") - F.col("a") - F.col("b") * F.col("x"), 5).alias("resid"))


@query("""
WITH y AS (SELECT l_suppkey, year(l_shipdate) AS y, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY ALL), h AS (SELECT *, sum(n) OVER w AS pn, sum(r) OVER w AS pr FROM y WINDOW w AS (PARTITION BY l_suppkey ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT y, avg(pr::DOUBLE / pn) AS m, var_samp(pr::DOUBLE / pn) AS v FROM h WHERE pn >= 5 GROUP BY 1), k AS (SELECT y, m, CASE WHEN v > 0 THEN CASE WHEN m * (1 - m) / v - 1 < 2 THEN 2 WHEN m * (1 - m) / v - 1 > 500 THEN 500 ELSE m * (1 - m) / v - 1 END END AS k FROM p)
SELECT l_suppkey, h.y, round(CASE WHEN k IS NULL THEN r::DOUBLE / n ELSE (r + m * k) / (n + k) END, 6) AS shrunk FROM h LEFT JOIN k ON h.y = k.y
""")
def beta_shrink(spark, d):
    y = table(spark, d, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag").groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("r"))
    w = panel.before(Window.partitionBy("l_suppkey").orderBy("y"))
    h = y.withColumn("pn", F.sum("n").over(w)).withColumn("pr", F.sum("r").over(w))
    rate = F.col("pr") / F.col("pn")
    k = h.where("pn >= 5").groupBy("y").agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v")).select("y", "m", F.when(F.col("v") > 0, values.clip(F.col("m") * (1 - F.col("m")) / F.nullif(F.col("v"), F.lit(0.0)) - 1, 2.0, 500.0)).alias("k"))
    return h.join(k, "y", "left").select("l_suppkey", "y", r6(F.when(F.col("k").isNull(), F.col("r") / F.col("n")).otherwise((F.col("r") + F.col("m") * F.col("k")) / (F.col("n") + F.col("k")))).alias("shrunk"))


@query("""
WITH r AS (SELECT o_orderpriority AS c, (rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0::DOUBLE) AS a,
  (rank() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_orderpriority, o_custkey) - 1) / 2.0::DOUBLE) AS b FROM orders)
SELECT c, count(*) AS n, CASE WHEN count(*) >= 3 THEN round(corr(a, b), 6) END AS rho FROM r GROUP BY 1
""")
def spearman_by_class(spark, d):
    g = ["o_orderpriority"]
    r = table(spark, d, "orders", "o_orderpriority", "o_totalprice", "o_custkey").select(F.col("o_orderpriority").alias("c"), panel.doubled_rank(F.col("o_totalprice"), *g).cast("double").alias("a"), panel.doubled_rank(F.col("o_custkey"), *g).cast("double").alias("b"))
    return r.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) >= 3, r6(panel.correlation(F.col("a"), F.col("b")))).alias("rho"))


@query("""
WITH r AS (SELECT p_partkey, 2 * rank() OVER (ORDER BY p_retailprice) + count(*) OVER (PARTITION BY p_retailprice) - 1 AS a, 2 * rank() OVER (ORDER BY p_size) + count(*) OVER (PARTITION BY p_size) - 1 AS b FROM part)
SELECT p_partkey, alpha, (10 - alpha) * a + alpha * b AS numerator FROM r, range(0, 11) t(alpha)
""")
def rank_blend(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_retailprice", "p_size")
    for value, name in (("p_retailprice", "a"), ("p_size", "b")):
        p = p.join(panel.standing(p, value).select(value, (2 * F.col("less") + F.col("ties") + 1).alias(name)), value)
    return p.withColumn("alpha", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(10).cast("long")))).select("p_partkey", "alpha", ((10 - F.col("alpha")) * F.col("a") + F.col("alpha") * F.col("b")).alias("numerator"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_custkey * 1.5::DOUBLE ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN c_custkey::DOUBLE END AS score FROM customer")
def tri_state_patch(spark, d):
    base = table(spark, d, "customer", "c_custkey", "c_acctbal")
    k = F.col("c_custkey")
    change = base.select("c_custkey", F.when(k % 5 == 0, "NA").when(k % 7 == 0, (k * 1.5).cast("string")).otherwise("").alias("c_acctbal"), F.when(k % 3 == 0, k.cast("string")).alias("score"))
    return quality.patch(base, change, "c_custkey")


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN 'quantity' WHEN l_discount > 0.095 THEN 'discount' END AS reason FROM lineitem)
SELECT l_orderkey, l_linenumber, reason, max(CASE WHEN reason IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS refused FROM r
""")
def quarantine_groups(spark, d):
    r = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount").withColumn("reason", F.get(quality.reasons((F.col("l_quantity") <= 45, "quantity"), (F.col("l_discount") <= 0.095, "discount")), F.lit(0)))
    return r.select("l_orderkey", "l_linenumber", "reason", quality.quarantine(r, ["l_orderkey"], F.col("reason").isNotNull()).cast("int").alias("refused"))


@query("""
WITH s AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS t FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(o_totalprice - coalesce(t, 0), 2) AS gap, CASE WHEN t IS NULL THEN 'no lines' WHEN abs(o_totalprice - t) <= 0.01 * o_totalprice THEN 'agree' ELSE 'differ' END AS verdict FROM orders LEFT JOIN s ON o_orderkey = l_orderkey
""")
def reconcile(spark, d):
    s = table(spark, d, "lineitem", "l_orderkey", "l_extendedprice", "l_discount", "l_tax").groupBy("l_orderkey").agg(F.sum(_revenue() * (1 + F.col("l_tax"))).alias("t"))
    t, p = F.col("t"), F.col("o_totalprice")
    return table(spark, d, "orders", "o_orderkey", "o_totalprice").join(s, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.round(p - F.coalesce(t, F.lit(0.0)), 2).alias("gap"), F.when(t.isNull(), "no lines").when(F.abs(p - t) <= 0.01 * p, "agree").otherwise("differ").alias("verdict"))


@query("""
WITH s AS (SELECT s_suppkey, regexp_extract(s_name, '([0-9]+)$', 1)::BIGINT AS k FROM supplier), c AS (SELECT c_custkey, regexp_extract(c_name, '([0-9]+)$', 1)::BIGINT AS k FROM customer),
t AS (SELECT s_suppkey, c_custkey, 1 AS tier FROM s JOIN c ON s.k = c.k UNION ALL SELECT s_suppkey, c_custkey, 2 FROM s JOIN c ON s.k // 4 = c.k // 4),
b AS (SELECT s_suppkey, tier, count(DISTINCT c_custkey) AS n, min(c_custkey) AS r FROM t GROUP BY ALL)
SELECT s_suppkey, tier, CASE WHEN n = 1 THEN r END AS c_custkey, CASE WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS status FROM b QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY tier) = 1
""")
def name_tiers(spark, d):
    s = table(spark, d, "supplier", "s_suppkey", "s_name").select("s_suppkey", F.regexp_extract("s_name", "([0-9]+)$", 1).cast("long").alias("k"))
    c = table(spark, d, "customer", "c_custkey", "c_name").select("c_custkey", F.regexp_extract("c_name", "([0-9]+)$", 1).cast("long").alias("k"))
    exact = s.join(c, "k").select("s_suppkey", "c_custkey", F.lit(1).alias("tier"))
    loose = s.withColumn("m", F.floor(F.col("k") / 4)).join(c.withColumn("m", F.floor(F.col("k") / 4)), "m").select("s_suppkey", "c_custkey", F.lit(2).alias("tier"))
    return quality.tiered(exact.unionByName(loose), "s_suppkey", "c_custkey")


@query("""
WITH p AS (SELECT DISTINCT p_name FROM part)
SELECT a.p_name AS a, b.p_name AS b, levenshtein(a.p_name, b.p_name) AS dist FROM p a JOIN p b ON a.p_name < b.p_name WHERE levenshtein(a.p_name, b.p_name) <= 2
""")
def edit_distance_block(spark, d):
    """Names within two edits: they share what is left of them after deleting up to two letters."""
    p = table(spark, d, "part", "p_name").distinct().select("p_name", F.explode(values.deletions(F.col("p_name"))).alias("t"))
    j = p.withColumnRenamed("p_name", "a").join(p.withColumnRenamed("p_name", "b"), "t").where("a < b").select("a", "b").distinct()
    return j.withColumn("dist", F.levenshtein("a", "b", 2)).where("dist >= 0").select("a", "b", F.col("dist").cast("long").alias("dist"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split_regex(left(text, 100000000), '[.,;]| and | et | und ')) AS part FROM documents) SELECT doc_id, count(*) AS parts, count(DISTINCT trim(part)) AS kinds FROM l WHERE trim(part) <> '' GROUP BY 1
""")
def split_composite(spark, d):
    parts = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.explode(F.split("text", "[.,;]| and | et | und ")).alias("part")).where("trim(part) <> ''")
    return parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("parts"), F.count_distinct(F.trim("part")).alias("kinds"))


@query("SELECT c_custkey, lower(trim(regexp_replace(c_name, '[^A-Za-z0-9]+', ' ', 'g'))) AS key, array_to_string(list_sort(string_split(lower(trim(regexp_replace(c_name, '[^A-Za-z0-9]+', ' ', 'g'))), ' ')), ' ') AS bag FROM customer")
def name_keys(spark, d):
    return table(spark, d, "customer", "c_custkey", "c_name").select("c_custkey", quality.normalised(F.col("c_name")).alias("key"), quality.sorted_tokens(F.col("c_name")).alias("bag"))


@query("""
WITH e AS (SELECT time_bucket(INTERVAL '1 day', ts) AS b, event_type, value FROM events) SELECT CAST(b::DATE AS VARCHAR) AS day, event_type, count(*) AS n, round(sum(value), 6) AS v FROM e GROUP BY ALL
""")
def tumbling_daily(spark, d):
    from ..streaming import daily_counts

    return daily_counts(table(spark, d, "events", "ts", "event_type", "value"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 2 THEN date_trunc('month', o_orderdate) WHEN 3 THEN date_trunc('year', o_orderdate) ELSE o_orderdate END::DATE::VARCHAR AS said,
  (o_orderdate::DATE + CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN (o_orderkey % 9)::INTEGER ELSE 14 END)::DATE::VARCHAR AS later FROM orders
""")
def dates_in_prose(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    k, form = F.col("o_orderkey"), lambda f: F.date_format("o_orderdate", f)
    said = F.when(k % 4 == 0, F.concat(F.lit("signed on "), form("MMMM d, yyyy"))).when(k % 4 == 1, F.concat(form("d MMM yyyy"), F.lit(" at noon"))).when(k % 4 == 2, F.concat(F.lit("since "), form("MMMM yyyy"))).otherwise(F.concat(F.lit("class of "), form("yyyy")))
    later = F.when(k % 3 == 0, "the next day").when(k % 3 == 1, F.concat((k % 9).cast("string"), F.lit(" days later"))).otherwise("2 weeks later")
    return o.select("o_orderkey", values.prose_date(said).cast("string").alias("said"), values.relative_date(later, F.col("o_orderdate").cast("date")).cast("string").alias("later"))


@query("""
SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON list_sort(string_split(a.c_name, '')) = list_sort(string_split(b.c_name, '')) AND a.c_custkey < b.c_custkey
WHERE damerau_levenshtein(a.c_name, b.c_name) = 1
""")
def neighbour_swap_block(spark, d):
    # Texts that differ by a swap have the same letters: these are the block.
    c = table(spark, d, "customer", "c_custkey", "c_name").withColumn("bag", F.array_join(F.array_sort(F.split("c_name", "")), ""))
    x, y = c.select("bag", F.col("c_custkey").alias("a"), F.col("c_name").alias("m")), c.select("bag", F.col("c_custkey").alias("b"), F.col("c_name").alias("n"))
    return x.join(y, "bag").where("a < b").where(quality.one_swap(F.col("m"), F.col("n"))).select("a", "b")


@query("""
SELECT DISTINCT x.l_suppkey AS a, y.l_suppkey AS b FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND y.l_suppkey = x.l_suppkey + 1
""")
def same_place_clash(spark, d):
    s = table(spark, d, "supplier", "s_suppkey")
    pairs = s.select(F.col("s_suppkey").alias("a"), (F.col("s_suppkey") + 1).alias("b"))
    return quality.clashes(pairs, table(spark, d, "lineitem", "l_orderkey", "l_suppkey"), "a", "b", "l_suppkey", "l_orderkey")


@query("""
WITH m AS (SELECT p_brand AS g, count(*) AS n, avg(p_retailprice) AS my, avg(p_size) AS mx, avg(p_partkey % 50) AS mz, var_pop(p_size) AS xx, var_pop(p_partkey % 50) AS zz, covar_pop(p_size, p_partkey % 50) AS xz,
  covar_pop(p_size, p_retailprice) AS xy, covar_pop(p_partkey % 50, p_retailprice) AS zy FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN n >= 6 THEN round(p_retailprice - my - (xy * zz - zy * xz) / (xx * zz - xz * xz) * (p_size - mx) - (zy * xx - xy * xz) / (xx * zz - xz * xz) * (p_partkey % 50 - mz) + 1.37e-5, 4) END AS residual FROM part JOIN m ON p_brand = g
""")
def ols_two_regressors(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_brand", "p_size", "p_retailprice")
    r = panel.two_regressor_residual(F.col("p_retailprice"), F.col("p_size").cast("double"), (F.col("p_partkey") % 50).cast("double"), Window.partitionBy("p_brand"), 6)
    return p.select("p_partkey", off_grid(r).alias("residual"))


@query("""
WITH c AS (SELECT c_custkey, c_mktsegment AS s, c_acctbal, c_nationkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS own, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('7|' || c_custkey)) AS dealt FROM customer)
SELECT x.c_custkey, x.s AS c_mktsegment, y.c_acctbal, y.c_nationkey FROM c x JOIN c y ON x.s = y.s AND x.own = y.dealt
""")
def permutation_control(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    return panel.permuted(c, "c_custkey", ["c_mktsegment"], ["c_acctbal", "c_nationkey"], 7)


@query("""
WITH r AS (SELECT c_custkey, c_nationkey, count(*) AS n, coalesce(sum(o_totalprice), 0) AS v FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
k AS (SELECT c_custkey, 2 * rank() OVER (PARTITION BY c_nationkey ORDER BY n) + count(*) OVER (PARTITION BY c_nationkey, n) - 1 AS kn, 2 * rank() OVER (PARTITION BY c_nationkey ORDER BY v) + count(*) OVER (PARTITION BY c_nationkey, v) - 1 AS kv FROM r)
SELECT recipe, c_custkey, (un * kn + uv * kv)::BIGINT AS blend FROM k, (VALUES ('even', 6, 6), ('count', 9, 3), ('value', 2, 10)) w(recipe, un, uv)
""")
def recipe_blends(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_totalprice").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), panel.exact_sum(F.col("o_totalprice").cast("double")).alias("total"))
    c = table(spark, d, "customer", "c_custkey", "c_nationkey").groupBy("c_custkey", "c_nationkey").agg(F.count(F.lit(1)).alias("rows"))
    # A repeated customer counts its orders as often, and one without any price has a value of 0.
    r = c.join(o, F.col("c_custkey") == F.col("o_custkey")).withColumns({"n": F.col("orders") * F.col("rows"), "v": F.coalesce(F.col("total") * F.col("rows"), F.lit(0.0))})
    k = r.select("c_custkey", panel.doubled_rank(F.col("n"), "c_nationkey").alias("n"), panel.doubled_rank(F.col("v"), "c_nationkey").alias("v"))
    recipes = (("even", 6, 6), ("count", 9, 3), ("value", 2, 10))
    if any(a + b != 12 for _, a, b in recipes):
        raise ValueError("units of a recipe sum to 12")
    blends = F.explode(F.array(*[F.struct(F.lit(name).alias("recipe"), (a * F.col("n") + b * F.col("v")).cast("long").alias("blend")) for name, a, b in recipes])).alias("x")
    return k.select("c_custkey", blends).select("x.recipe", "c_custkey", "x.blend")


@query("""
WITH p AS (SELECT doc_id, string_split(' ' || coalesce(text, '') || ' ', ' a ') AS p FROM documents)
SELECT doc_id, (len(p) - 1)::BIGINT AS hits, len(list_filter(p[1:len(p) - 1], lambda x: regexp_matches(' ' || right(x, 20) || ' ', ' (no|not|ni|de|le) ')))::BIGINT AS negated FROM p
""")
def negated_hits(spark, d):
    total, negated = values.hits(F.col("text"), "a", ("no", "not", "ni", "de", "le"))
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", total.alias("hits"), negated.alias("negated"))


@query("""
WITH m AS (SELECT l_shipdate::DATE AS day, l_returnflag AS arm, avg(l_quantity) AS v FROM lineitem GROUP BY ALL)
SELECT x.arm, count(*) AS n, round(avg(x.v - y.v) + 1.37e-5, 4) AS mean_delta, count(*) FILTER (x.v > y.v) AS wins FROM m x JOIN m y ON x.day = y.day AND y.arm = 'N' AND x.arm <> 'N' GROUP BY 1
""")
def control_deltas(spark, d):
    lines = table(spark, d, "lineitem", "l_shipdate", "l_returnflag", "l_quantity")
    m = lines.groupBy(F.col("l_shipdate").cast("date").alias("day"), F.col("l_returnflag").alias("arm")).agg(F.avg("l_quantity").alias("v"))
    return panel.paired_deltas(m, ["day"], "arm", "v", "N").withColumn("mean_delta", off_grid(F.col("mean_delta")))


def cubic_sql(rows: str, keys: str, least: int, tails: tuple[float, float] | None, digits: int) -> str:
    """Cubic fits on earlier cohorts from ``rows`` (keys, c, u, y): covariances of a theta join, solved by Cramer's rule."""
    a = [["a11", "a12", "a13"], ["a12", "a22", "a23"], ["a13", "a23", "a33"]]
    det = lambda m: "(" + " + ".join(f"{m[0][i]} * ({m[1][(i + 1) % 3]} * {m[2][(i + 2) % 3]} - {m[1][(i + 2) % 3]} * {m[2][(i + 1) % 3]})" for i in range(3)) + ")"
    beta = [f"{det([[f'b{i + 1}' if j == k else a[i][j] for j in range(3)] for i in range(3)])} / {det(a)} AS k{k + 1}" for k in range(3)]
    cov = [f"covar_pop(u ** {i}, u ** {j}) AS a{i}{j}" for i in (1, 2, 3) for j in range(i, 4)] + [f"covar_pop(u ** {i}, y) AS b{i}" for i in (1, 2, 3)] + [f"avg(u ** {i}) AS m{i}" for i in (1, 2, 3)]
    bounds = f", quantile_cont(u, {tails[0]}) AS lo, quantile_cont(u, {tails[1]}) AS hi" if tails else ", min(u) - 1e9 AS lo, max(u) + 1e9 AS hi"
    return f"""
WITH l AS ({rows}), k AS (SELECT DISTINCT c FROM l),
f AS (SELECT k.c AS cohort, count(*) AS n, avg(y) AS my, var_pop(y) AS vy, {", ".join(cov)}{bounds} FROM k JOIN l p ON p.c < k.c GROUP BY 1 HAVING count(*) >= {least}),
g AS (SELECT *, {", ".join(beta)} FROM f), h AS (SELECT *, my - k1 * m1 - k2 * m2 - k3 * m3 AS k0, sqrt((vy - k1 * b1 - k2 * b2 - k3 * b3) * n / (n - 1)) AS sd FROM g),
e AS (SELECT l.*, sd, least(greatest(u, lo), hi) AS v, k0 + k1 * v + k2 * v ** 2 + k3 * v ** 3 AS e FROM l LEFT JOIN h ON c = cohort)
SELECT {keys}, round(y - e + 1.37e-5, {digits}) + 0 AS residual, round((y - e) / sd + 1.37e-5, 4) + 0 AS z FROM e"""


@query(cubic_sql("SELECT l_orderkey, l_linenumber, year(l_shipdate) AS c, (l_quantity - 25) / 25 AS u, l_extendedprice AS y FROM lineitem", "l_orderkey, l_linenumber", 500, (0.005, 0.995), 2))
def expanding_cubic(spark, d):
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice").withColumn("c", F.year("l_shipdate"))
    f = fits.expanding_cubic(rows, "c", "l_quantity", "l_extendedprice", 25.0, 25.0, 500, (0.005, 0.995))
    return f.select("l_orderkey", "l_linenumber", F.round(F.col("residual") + F.lit(1.37e-5), 2).alias("residual"), off_grid(F.col("z")).alias("z"))


@query(cubic_sql("SELECT o_orderkey, year(o_orderdate) AS c, (ln(o_totalprice) - 11) / 2 AS u, count(*)::DOUBLE AS y FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_totalprice > 0 GROUP BY ALL", "o_orderkey", 200, None, 4))
def log_cubic_expected(spark, d):
    orders = table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_totalprice").where("o_totalprice > 0")
    n = table(spark, d, "lineitem", "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("double").alias("lines"))
    rows = orders.join(n, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", F.year("o_orderdate").alias("c"), F.log("o_totalprice").alias("x"), "lines")
    f = fits.expanding_cubic(rows, "c", "x", "lines", 11.0, 2.0, 200)
    return f.select("o_orderkey", off_grid(F.col("residual")).alias("residual"), off_grid(F.col("z")).alias("z"))


@query("""
WITH RECURSIVE o AS (SELECT o_custkey, count(*) AS c, sum(o_totalprice) AS v, max(o_totalprice) AS top FROM orders GROUP BY 1),
r AS (SELECT c_custkey AS k, c_nationkey < 20 AS train, CASE WHEN c_custkey % 7 <> 0 THEN coalesce(c, 0) END AS n, v, CASE WHEN c_custkey % 5 <> 0 THEN -top END AS w FROM customer LEFT JOIN o ON o_custkey = c_custkey),
s AS (SELECT avg(n) AS mn, stddev_samp(n) AS sn, avg(v) AS mv, stddev_samp(v) AS sv, avg(w) AS mw, stddev_samp(w) AS sw FROM r WHERE train),
z AS (SELECT k, train, (n - mn) / sn AS a, (v - mv) / sv AS b, -(w - mw) / sw AS c FROM r, s),
m AS (SELECT covar_samp(a, a) AS aa, covar_samp(a, b) AS ab, covar_samp(a, c) AS ac, covar_samp(b, b) AS bb, covar_samp(b, c) AS bc, covar_samp(c, c) AS cc FROM z WHERE train AND a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL),
p AS (SELECT 0 AS i, 0.6e0 AS x, 0.6e0 AS y, 0.6e0 AS q UNION ALL
  SELECT i + 1, (aa * x + ab * y + ac * q) / t, (ab * x + bb * y + bc * q) / t, (ac * x + bc * y + cc * q) / t
  FROM (SELECT *, sqrt((aa * x + ab * y + ac * q) ** 2 + (ab * x + bb * y + bc * q) ** 2 + (ac * x + bc * y + cc * q) ** 2) AS t FROM p, m WHERE i < 400))
SELECT k, CASE WHEN (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT >= 2 THEN round(coalesce(a, 0) * x + coalesce(b, 0) * y + coalesce(c, 0) * q + 1.37e-5, 4) + 0 END AS pc1 FROM z, p WHERE i = 400
""")
def first_component(spark, d):
    o = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("v"), F.max("o_totalprice").alias("w"))
    c = table(spark, d, "customer", "c_custkey", "c_nationkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    rows = c.select(F.col("c_custkey").alias("k"), "c_nationkey", F.when(F.col("c_custkey") % 7 != 0, F.coalesce("n", F.lit(0))).alias("n"), "v", F.when(F.col("c_custkey") % 5 != 0, -F.col("w")).alias("w"))
    return fits.first_component(rows, ["n", "v", "w"], [1, 1, -1], 2, "pc1", F.col("c_nationkey") < 20).select("k", off_grid(F.col("pc1")).alias("pc1"))


@query()
def ridge_ratings(spark, d):
    """Nations rated by quantities over 25 in lines between customer's and supplier's, a season a year."""
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag")
    orders = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    sides = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    place = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", -1).otherwise(0)
    games = sides.select(F.year("o_orderdate").alias("season"), F.struct("l_orderkey", "l_linenumber").alias("game"), "c_nationkey", "s_nationkey", (F.col("l_quantity") - 25).alias("margin"), place.alias("place"))
    return fits.ridge_ratings(games, "season", "game", "c_nationkey", "s_nationkey", "margin", "place").withColumn("rating", r6(F.col("rating")))


@query("""
WITH a AS (SELECT l_orderkey, l_suppkey AS s, l_quantity >= 10 AS alive, l_quantity >= 10 AND l_returnflag = 'R' AS f, l_quantity >= 10 AND l_extendedprice > 50000 AS g FROM lineitem),
n AS (SELECT l_orderkey, count(DISTINCT s) FILTER (alive) AS n, min(s) FILTER (alive) AS s, count(DISTINCT s) FILTER (f) AS nf, min(s) FILTER (f) AS sf, count(DISTINCT s) FILTER (g) AS ng, min(s) FILTER (g) AS sg FROM a GROUP BY 1)
SELECT l_orderkey, CASE WHEN nf = 1 THEN sf WHEN ng = 1 THEN sg WHEN n = 1 THEN s END AS l_suppkey, CASE WHEN nf = 1 THEN 'returned' WHEN ng = 1 THEN 'dear' WHEN n = 1 THEN 'sole' WHEN n = 0 THEN 'none left' ELSE 'ambiguous' END AS decided_by FROM n
""")
def evidence_cascade(spark, d):
    lines = table(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_extendedprice")
    return matching.cascade(lines, "l_orderkey", "l_suppkey", [("small", "reject", F.col("l_quantity") < 10), ("returned", "agree", F.col("l_returnflag") == "R"), ("dear", "agree", F.col("l_extendedprice") > 50000)])


@query()
def tolerance_events(spark, d):
    """Lines of a part as events: quantities within 3 and discounts within 0.01 belong together unless their statuses, where told, differ."""
    lines = table(spark, d, "lineitem", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    rows = lines.withColumn("source", F.when(F.col("l_quantity") > 25, F.col("l_linestatus")))
    return matching.tolerance_clusters(rows, ["l_partkey"], "l_returnflag", "source", {"l_quantity": 3.0, "l_discount": 0.01})


@query()
def similar_names(spark, d):
    """Parts of one brand, type and size with names alike in 0.85 or more of their characters."""
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return matching.similar_within(p, ["p_brand", "p_type", "p_size"], "p_partkey", "p_name").select("a", "b", r6(F.col("ratio")).alias("ratio"))


def _order_cells():
    """Cells of an order in one of two layouts, by its customer."""
    key, total, status = (F.col(c).cast("string") for c in ("o_orderkey", "o_totalprice", "o_orderstatus"))
    return F.when(F.col("o_custkey") % 2 == 0, F.array(key, total, status)).otherwise(F.array(status, key, total)).alias("cells")


def _layout():
    return F.when(F.col("o_custkey") % 2 == 0, F.array(*map(F.lit, ("Order &amp; Key", "Total  Price", "Status")))).otherwise(F.array(*map(F.lit, ("STATUS", "Order &amp; Key", "Price"))))


NAMES = {"order & key": "key", "total price": "total", "price": "total", "status": "status"}


@query("SELECT o_custkey, o_orderkey AS key, o_totalprice AS total, o_orderstatus AS status FROM orders")
def html_order_tables(spark, d):
    """Pages with a table a customer, in two layouts, read back by their headers."""
    rows = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus").groupBy("o_custkey").agg(F.collect_list(_order_cells()).alias("rows"))
    tr = lambda cells, tag: F.concat(F.lit("<tr>"), F.array_join(F.transform(cells, lambda c: F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))
    page = F.concat(F.lit("<p>x</p><table>"), tr(_layout(), "th"), F.array_join(F.transform("rows", lambda r: tr(r, "td")), ""), F.lit("</table>"))
    cells = markup.html_tables(rows.select("o_custkey", page.alias("html")), "o_custkey", "html")
    # A table's header row and its rows share a customer's key.
    head = cells.where("is_header").select("o_custkey", "table_no", F.col("cells").alias("header"))
    m = cells.where("not is_header").join(head, ["o_custkey", "table_no"]).select("o_custkey", markup.by_header(F.col("header"), F.col("cells"), NAMES).alias("m"))
    return m.select("o_custkey", F.col("m")["key"].cast("long").alias("key"), F.col("m")["total"].cast("double").alias("total"), F.col("m")["status"].alias("status"))


@query("SELECT o_custkey, o_orderkey AS key, o_totalprice AS total, CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus END AS status FROM orders")
def wikitext_order_tables(spark, d):
    """Wikitext a customer, with a header row for even keys and none for odd ones, whose cells go by position."""
    o = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    even = F.col("o_custkey") % 2 == 0
    cells = F.when(even, F.array(F.col("o_orderstatus"), F.concat(F.lit('align="right" | '), F.col("o_orderkey").cast("string")), F.col("o_totalprice").cast("string"))).otherwise(F.array(F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")))
    rows = o.groupBy("o_custkey").agg(F.collect_list(F.concat(F.lit("|-\n|"), F.array_join(cells, "||"))).alias("rows"))
    text = F.concat(F.lit("== Orders ==\n{| class=x\n"), F.when(even, F.lit("! Status !! Order & Key !! Price\n")).otherwise(F.lit("")), F.array_join("rows", "\n"), F.lit("\n|}"))
    found = markup.wikitext_tables(rows.select("o_custkey", text.alias("text")), "o_custkey", "text")
    m = found.select("o_custkey", markup.by_header(F.col("header"), F.col("cells"), NAMES, {2: ["key", "total"]}).alias("m"))
    return m.select("o_custkey", F.col("m")["key"].cast("long").alias("key"), F.col("m")["total"].cast("double").alias("total"), F.col("m")["status"].alias("status"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def embedded_objects(spark, d):
    page = F.concat(F.lit("<script>var data = [1]; data = "), F.col("props"), F.lit("; var other = {\"k\": -1}</script>"))
    found = markup.embedded_object(page, r"data\s*=\s*")
    return table(spark, d, "events", "event_id", "props").select("event_id", values.number(F.get_json_object(found, "$.k")).alias("k"))


@query("""
SELECT c_custkey, unnest(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN ['nation', 'balance'] ELSE ['balance', 'nation'] END) AS label, unnest([c_acctbal, c_nationkey::DOUBLE]) AS value FROM customer
""")
def banner_grid(spark, d):
    grid = markup.by_banner(F.col("c_mktsegment"), F.array("c_acctbal", F.col("c_nationkey").cast("double")), [("^(BUILDING|MACHINERY)$", ["nation", "balance"])], ["balance", "nation"])
    return table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey").select("c_custkey", F.explode(grid).alias("label", "value"))


@query(r"""
WITH h AS (SELECT page_id, regexp_extract_all(html, '<h([1-6])[^>]*>([^<]*)</h[1-6]>', 1) AS l, regexp_extract_all(html, '<h([1-6])[^>]*>([^<]*)</h[1-6]>', 2) AS t, string_split_regex(html, '<h[1-6][^>]*>[^<]*</h[1-6]>') AS b FROM pages),
s AS (SELECT page_id, unnest(range(1, len(l) + 1)) AS i, unnest(l)::INT AS level, trim(unnest(t)) AS title FROM h),
o AS (SELECT x.page_id, x.i, x.level, y.i AS j, y.title FROM s x JOIN s y ON x.page_id = y.page_id AND y.i <= x.i AND NOT EXISTS (SELECT 1 FROM s m WHERE m.page_id = x.page_id AND m.i > y.i AND m.i <= x.i AND m.level <= y.level)),
p AS (SELECT page_id, i, level, string_agg(title, ' / ' ORDER BY j) AS path FROM o GROUP BY ALL UNION ALL SELECT page_id, 0, 0, '' FROM pages WHERE html IS NOT NULL)
SELECT p.page_id, level, path, length(b[i + 1])::INT AS n_body FROM p JOIN h ON p.page_id = h.page_id
""")
def heading_tree(spark, d):
    tree = markup.section_tree(F.col("html"), r"<h([1-6])[^>]*>([^<]*)</h[1-6]>", 1, 2)
    return table(spark, d, "pages", "page_id", "html").select("page_id", F.explode(tree).alias("s")).select("page_id", "s.level", F.array_join("s.path", " / ").alias("path"), F.char_length("s.body").alias("n_body"))


from . import cohorts, files, identity, merging  # noqa: E402, F401  they add their queries

__all__ = ["QUERIES", "SQL"]
