"""Queries of identity: alternate keys, fall-through tiers, evidence of ages and dates, surrogate ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import identity, values
from ..sources import table
from .registry import query, r6


@query("""
WITH n AS (SELECT p_partkey, lower(p_type) || ' ' || p_name AS name FROM part), w AS (SELECT *, string_split(name, ' ') AS w FROM n), f AS (SELECT *, w[1] AS a, w[len(w)] AS z FROM w)
SELECT p_partkey, 1 AS tier, name AS key FROM f UNION ALL SELECT p_partkey, 2, 'cheap ' || array_to_string(w[2:], ' ') FROM f WHERE a = 'economy' UNION ALL
SELECT p_partkey, 4, a || ' ' || z FROM f WHERE len(w) > 2 UNION ALL SELECT p_partkey, 5, substr(a, 1, 1) || ' ' || z FROM f WHERE len(w) > 1 UNION ALL
SELECT p_partkey, 6, array_to_string(w, '') FROM f WHERE len(w) > 1 UNION ALL SELECT p_partkey, 7, substr(a, 1, 4) || ' ' || z FROM f WHERE len(w) > 1 AND length(a) > 4
""")
def name_variants(spark, d):
    """Keys under which a part of type and name may be found."""
    p = table(spark, d, "part", "p_partkey", "p_type", "p_name")
    keys = identity.key_variants(F.concat_ws(" ", "p_type", "p_name"), {"economy": "cheap"})
    return p.select("p_partkey", F.explode(keys).alias("x")).select("p_partkey", "x.tier", "x.key")


@query("""
WITH t AS (SELECT l_partkey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS tier, count(DISTINCT CASE WHEN l_quantity >= 45 THEN l_suppkey END) AS n, min(CASE WHEN l_quantity >= 45 THEN l_suppkey END) AS r FROM lineitem GROUP BY ALL),
f AS (SELECT l_partkey, min(CASE WHEN n > 0 THEN tier END) AS tier FROM t GROUP BY 1)
SELECT f.l_partkey, f.tier, CASE WHEN n = 1 THEN r END AS l_suppkey, CASE WHEN f.tier IS NULL THEN 'none' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS status FROM f LEFT JOIN t ON f.l_partkey = t.l_partkey AND f.tier = t.tier
""")
def falling_tiers(spark, d):
    lines = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    tier = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3)
    return identity.first_plausible(lines.withColumn("tier", tier), "l_partkey", "l_suppkey", "tier", F.col("l_quantity") >= 45)


@query("SELECT l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE abs(p_size - l_quantity) <= 2.5 GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1")
def age_consistent_match(spark, d):
    j = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_quantity").join(table(spark, d, "part", "p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return identity.age_consistent(j, "l_partkey", "l_suppkey", F.col("p_size"), F.col("l_quantity"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING min(l_linestatus) <> max(l_linestatus))")
def conflicting_identities(spark, d):
    return identity.consistent(table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_linestatus"), "l_orderkey", "l_linestatus").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, substr(sha256(length(c_name) || ':' || c_name || ',' || CASE WHEN c_nationkey > 20 THEN '-' ELSE length(c_nationkey::VARCHAR) || ':' || c_nationkey END), 1, 16) AS id FROM customer")
def surrogate_ids(spark, d):
    return table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey").select("c_custkey", identity.surrogate(F.col("c_name"), F.when(F.col("c_nationkey") <= 20, F.col("c_nationkey"))).alias("id"))


@query("""
WITH j AS (SELECT l_shipdate::DATE AS a, o_orderdate::DATE AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT CASE WHEN a = b THEN 'same' WHEN abs(date_diff('day', b, a)) <= 2 THEN 'close' WHEN year(a) = year(b) AND month(a) = day(b) AND day(a) = month(b) THEN 'swapped' WHEN year(a) = year(b) AND month(a) = month(b) THEN 'month' WHEN year(a) = year(b) THEN 'year' ELSE 'differ' END AS verdict FROM j)
SELECT verdict, count(*) AS n FROM s GROUP BY 1
""")
def date_agreement(spark, d):
    j = table(spark, d, "lineitem", "l_orderkey", "l_shipdate").join(table(spark, d, "orders", "o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(identity.date_agreement(F.col("l_shipdate"), F.col("o_orderdate")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey, round(date_diff('day', TIMESTAMP '1970-03-01', o_orderdate) / 365.25::DOUBLE, 6) AS age, CAST(month(o_orderdate) = 10 AND day(o_orderdate) = 15 AS INTEGER) AS placeholder,
  (SELECT CAST(x::DATE AS VARCHAR) FROM range(make_date(year(o_orderdate), 3, 11)::TIMESTAMP, make_date(year(o_orderdate), 3, 18)::TIMESTAMP, INTERVAL 1 DAY) t(x) WHERE dayofweek(x) = 0) AS sunday FROM orders
""")
def calendar_days(spark, d):
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", r6(fn.age(F.lit("1970-03-01").cast("date"), F.col("o_orderdate"))).alias("age"), fn.placeholder_date(F.col("o_orderdate")).cast("int").alias("placeholder"), fn.marked_sunday(F.year("o_orderdate")).cast("string").alias("sunday"))


@query("""
WITH t AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'Tier ' || s_suppkey WHEN s_suppkey % 3 = 1 THEN 'level ' || (['I', 'ii', 'III', 'IV', 'v', 'VI', 'vii', 'VIII', 'IX', 'X'])[s_suppkey % 10 + 1] ELSE 'open' END AS t FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey::DOUBLE WHEN 1 THEN s_suppkey % 10 + 1.0::DOUBLE END AS tier FROM t
""")
def tier_numbers(spark, d):
    romans = F.array(*[F.lit(x) for x in ("I", "ii", "III", "IV", "v", "VI", "vii", "VIII", "IX", "X")])
    k = F.col("s_suppkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("Tier "), k.cast("string"))).when(k % 3 == 1, F.concat(F.lit("level "), F.get(romans, (k % 10).cast("int")))).otherwise("open")
    return table(spark, d, "supplier", "s_suppkey").select("s_suppkey", fn.tier_number(text).alias("tier"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE least(s_suppkey % 60 + 1, CASE WHEN s_suppkey % 4 = 0 THEN 10 ELSE 99 END) END::INTEGER AS pick FROM supplier")
def picks_in_prose(spark, d):
    """The least place that a text made of a supplier's number foretells."""
    k = F.col("s_suppkey")
    number = (k % 60 + 1).cast("string")
    text = F.when(k % 4 == 3, F.concat(F.lit("Number "), number, F.lit(" in the list."))).when(k % 4 == 0, F.concat(F.lit("Once a top-10 prospect. Now Projected to go at no. "), number, F.lit("."))).otherwise(F.concat(F.lit("He is projected as the number "), number, F.lit(" choice")))
    return table(spark, d, "supplier", "s_suppkey").select("s_suppkey", fn.smallest_pick(text).alias("pick"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 0 THEN s_name END AS name, round(s_acctbal, 2)::VARCHAR AS balance FROM supplier")
def infobox_fields(spark, d):
    page = F.concat(F.lit("{{Infobox\n| Name = "), F.when(F.col("s_suppkey") % 5 > 0, F.col("s_name")).otherwise(""), F.lit("\n|balance="), F.col("s_acctbal").cast("string"), F.lit("\n}}\nText | name = other"))
    return table(spark, d, "supplier", "s_suppkey", "s_name", "s_acctbal").select("s_suppkey", fn.infobox(page, "name").alias("name"), fn.infobox(page, "balance").alias("balance"))


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS w FROM documents)
SELECT doc_id, len(list_filter(w, lambda x: x IN ('is', 'has', 'go') OR (ends_with(x, 'ing') AND length(x) > 5 AND x NOT IN ('during', 'morning'))))::BIGINT AS verbs FROM w
""")
def dictionary_counts(spark, d):
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", fn.dictionary_hits(words, ["is", "has", "go"], "ing", ["during", "morning"]).alias("verbs"))


@query("""
SELECT l_orderkey, l_linenumber, round(l_quantity + 0.4 * l_linenumber - 0.7 * (l_linenumber + 3) - l_suppkey % 5 + 1.37e-7, 6) AS score, round(l_quantity / (2 * (l_linenumber + 0.44 * (l_partkey % 7))), 6) AS ts, round(l_quantity * (240.0 / 5) / (l_linenumber * 90.0), 6) AS usg FROM lineitem
""")
def game_formulas(spark, d):
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    score = fn.game_score(points=q, field_goals=n, field_goal_attempts=n + 3, turnovers=F.col("l_suppkey") % 5)
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey").select(
        "l_orderkey", "l_linenumber", r6(score + F.lit(1.37e-7)).alias("score"), r6(fn.true_shooting(q, n, F.col("l_partkey") % 7)).alias("ts"), r6(fn.usage(q, n.cast("double"), F.lit(90.0), F.lit(240.0))).alias("usg")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE NULL END::BIGINT AS strict, year(o_orderdate)::INTEGER + 1 AS season, 12.0::DOUBLE * (5 + o_orderkey % 3) + o_orderkey % 12 AS inches FROM orders
""")
def text_numbers(spark, d):
    """Counts read strictly, seasons and lengths read from text."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    count = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".0"))).when(k % 3 == 1, F.concat(k.cast("string"), F.lit(".5"))).otherwise("-1")
    season = F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))
    feet = F.concat((5 + k % 3).cast("string"), F.lit("-"), (k % 12).cast("string"))
    return table(spark, d, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", values.count(count).cast("long").alias("strict"), values.season_end(season).cast("int").alias("season"), values.feet_inches(feet).alias("inches"))


@query("SELECT doc_id, md5(text) AS digest FROM documents WHERE lang IN ('fr', 'de', 'es') AND text IS NOT NULL")
def repaired_texts(spark, d):
    """Texts read with the wrong charset, twice, come back as they were."""
    docs = table(spark, d, "documents", "doc_id", "text", "lang").where("lang in ('fr', 'de', 'es') and text is not null")
    wrong = lambda c: F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", F.md5(values.repair_encoding(wrong(F.col("text")))).alias("digest"))
