"""Queries that write a table in a source's form, in the folder the session shares, and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources
from ..sources import table
from ..streaming import broken_links, insert_absent
from .registry import query


def _text(df, *columns):
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns or df.columns])


@query("SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer")
def csv_with_header(spark, d):
    """Gzip CSV with a header, the key first, null as empty, read back by schema."""
    at = sources.scratch(spark, "csv")
    c = table(spark, d, "customer", "c_name", "c_custkey", "c_acctbal", "c_mktsegment")
    sources.write_csv(c.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))), at, "c_custkey", "gzip")
    return sources.read_csv(spark, at, "c_custkey long, c_acctbal double, c_mktsegment string, c_name string")[0]


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 3 OR o_orderkey % 10 IS NULL")
def csv_without_header(spark, d):
    """Headerless CSV of several years as one table; lines with too few fields are refused."""
    at = sources.scratch(spark, "years")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    line = F.when(F.col("o_orderkey") % 10 == 3, F.concat_ws(",", "o_orderkey", "o_custkey")).otherwise(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus"))
    o.select(F.year("o_orderdate").alias("y"), line.alias("line")).write.partitionBy("y").text(at)
    return sources.read_csv(spark, f"{at}/*", "o_orderkey long, o_custkey long, o_orderstatus string", header=False, width=3)[0]


@query("SELECT s_nationkey AS nation, s_suppkey, s_acctbal AS balance FROM supplier")
def header_discovery(spark, d):
    """Sheets whose header stands somewhere below notes, its columns in an order of the sheet's own."""
    at = sources.scratch(spark, "sheets")
    row = F.when(F.col("s_nationkey") % 2 == 0, F.concat_ws(",", "s_suppkey", "s_acctbal")).otherwise(F.concat_ws(",", "s_acctbal", "s_suppkey"))
    head = F.when(F.col("s_nationkey") % 2 == 0, "Key, Balance").otherwise("Balance, Key")
    sheets = table(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_acctbal").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("rows"))
    sheets.select(F.col("s_nationkey").alias("n"), F.concat(F.lit("Sheet of "), "s_nationkey", F.lit("\n1,2\n"), head, F.lit("\n"), "rows").alias("value")).write.partitionBy("n").option("lineSep", "\n").text(at)
    lines = sources.lines_of(spark, f"{at}/*/*.txt")
    got = sources.below_header(lines, F.col("line").rlike("Key") & F.col("line").rlike("Balance"), ["Key", "Balance"])
    return got.select(F.regexp_extract("file", r"n=(\d+)", 1).cast("int").alias("nation"), F.col("Key").cast("long").alias("s_suppkey"), F.col("Balance").cast("double").alias("balance"))


@query("SELECT event_id, user_id, value FROM events WHERE event_id % 11 <> 0")
def json_lines(spark, d):
    """Gzip JSON lines; lines that are cut off are skipped."""
    at = sources.scratch(spark, "lines")
    e = table(spark, d, "events", "event_id", "user_id", "value")
    whole = F.to_json(F.struct("*"))
    e.select(F.when(F.col("event_id") % 11 == 0, F.substring(whole, 1, 12)).otherwise(whole).alias("value")).write.option("compression", "gzip").text(at)
    return sources.read_json_lines(spark, at, "event_id long, user_id long, value double")


@query("SELECT n_nationkey::VARCHAR AS key, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def json_documents(spark, d):
    """One JSON a nation, named by its key, over several lines."""
    at = sources.scratch(spark, "entities")
    n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    n.select(F.col("n_nationkey").alias("k"), F.regexp_replace(F.to_json(F.struct("n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))), ",", ",\n").alias("value")).write.partitionBy("k").text(at)
    got = spark.read.json(f"{at}/*", schema="n_name string, n_regionkey long", multiLine=True)
    return got.select(F.regexp_extract(F.input_file_name(), r"k=([^/]+)", 1).alias("key"), "n_name", "n_regionkey")


@query("SELECT o_custkey, o_orderkey AS key, o_totalprice AS total FROM orders")
def result_sets(spark, d):
    """Payloads of headers and rows, their columns found by name."""
    o = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_totalprice").withColumn("part", F.floor(F.col("o_orderkey") / 100))
    row = F.array(F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    p = o.groupBy("part").agg(F.to_json(F.struct(F.array(F.lit("TOTAL"), F.lit("CUST"), F.lit("KEY")).alias("headers"), F.collect_list(row).alias("rowSet"))).alias("payload"))
    got = sources.result_set(p, "payload", ["KEY", "TOTAL", "CUST"])
    return got.select(F.col("CUST").cast("long").alias("o_custkey"), F.col("KEY").cast("long").alias("key"), F.col("TOTAL").cast("double").alias("total"))


@query("SELECT p_partkey, p_name, p_size FROM part")
def positional_rows(spark, d):
    """JSON arrays of arrays, named by position."""
    p = table(spark, d, "part", "p_partkey", "p_name", "p_size").withColumn("part", F.floor(F.col("p_partkey") / 100))
    cells = F.array(F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_size").cast("string"))
    got = sources.positional_arrays(p.groupBy("part").agg(F.to_json(F.collect_list(cells)).alias("payload")), "payload", ["k", "name", "size"])
    return got.select(F.col("k").cast("long").alias("p_partkey"), F.col("name").alias("p_name"), F.col("size").cast("int").alias("p_size"))


@query("SELECT vec_id, len(embedding)::INTEGER AS dim, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 3) AS total FROM embeddings")
def fixed_arrays(spark, d):
    """Vectors, the columnar form of arrays of fixed length, scanned with their list."""
    e = table(spark, d, "embeddings", "vec_id", "embedding")
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    # A small negative total rounds to a zero that keeps its sign, as in the SQL.
    return e.select("vec_id", F.size("embedding").alias("dim"), F.when(total < 0, -F.round(-total, 3)).otherwise(F.round(total, 3)).alias("total"))


@query("SELECT 'nation=' || n_nationkey AS file, n_name AS text FROM nation")
def bundled_files(spark, d):
    """Many small files as one table; a second call finds nothing changed."""
    at, out = sources.scratch(spark, "small"), sources.scratch(spark, "bundle")
    table(spark, d, "nation", "n_nationkey", "n_name").select(F.concat(F.lit("nation="), "n_nationkey").alias("f"), F.col("n_name").alias("value")).write.partitionBy("f").option("lineSep", "\u0001").text(at)
    sources.bundle(spark, f"{at}/*/*.txt", out)
    again = sources.bundle(spark, f"{at}/*/*.txt", out)
    return again.select(F.url_decode(F.regexp_extract("file", "f=([^/]+)/", 1)).alias("file"), F.rtrim("text", F.lit("\u0001")).alias("text"))


@query("SELECT count(*) AS n FROM region")
def pinned_source(spark, d):
    """A file is read only while its bytes are the ones that were pinned."""
    at = f"{d}/region.parquet"
    digest = spark.read.format("binaryFile").load(at).select(F.sha2("content", 256)).first()[0]
    return spark.read.parquet(sources.pinned(spark, at, digest)).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey::VARCHAR AS c_custkey, '0' || c_nationkey || '.0' AS nation, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey * 2)::VARCHAR ELSE '' END AS twice FROM customer")
def appended_columns(spark, d):
    """Cells stay as they were written; new ones stand beside them."""
    c = table(spark, d, "customer", "c_custkey", "c_nationkey")
    base = c.select(F.col("c_custkey").cast("string").alias("c_custkey"), F.concat(F.lit("0"), "c_nationkey", F.lit(".0")).alias("nation"))
    return sources.append_columns(base, c.where("c_custkey % 2 = 0").select("c_custkey", (F.col("c_custkey") * 2).alias("twice")), "c_custkey")


@query("SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1")
def partitioned_sink(spark, d):
    """Orders written a folder a year; a run that is taken up again finds no year left to do."""
    at = sources.scratch(spark, "by-year")
    o = table(spark, d, "orders", "o_orderkey", "o_orderdate").withColumn("y", F.year("o_orderdate"))
    years = o.select("y").distinct()
    first = years.agg(F.min("y")).scalar()
    sources.write_partitioned(o.where(F.col("y") == first), at, "y")
    left = sources.missing_outputs(years, "y", at)
    o.join(left, "y", "left_semi").write.partitionBy("y").mode("append").parquet(at)
    assert not sources.missing_outputs(years, "y", at).limit(1).count()
    return spark.read.parquet(at).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, value FROM events")
def idempotent_sink(spark, d):
    """Batches that come twice are published once, rows without a key among them."""
    at = sources.scratch(spark, "sink")
    e = table(spark, d, "events", "event_id", "value")
    write = insert_absent(at, "event_id")
    for epoch in (0, 0, 1):
        write(e.where(f"event_id % 2 = {epoch}"), epoch)
    return spark.read.parquet(at).select("event_id", "value")


@query("SELECT event_id, 1::BIGINT AS seq FROM events WHERE event_id % 97 = 5")
def ledger_links(spark, d):
    """A hash-chained ledger of two entries an event, the second of which was changed afterwards for some."""
    e = table(spark, d, "events", "event_id", "user_id", "value")
    sealed = lambda previous, payload: F.sha2(F.concat(previous, payload), 256)
    user, value = F.col("user_id").cast("string"), F.col("value").cast("string")
    first = e.select("event_id", F.lit(0).cast("long").alias("seq"), user.alias("payload"), F.lit("").alias("previous"), sealed(F.lit(""), user).alias("digest"))
    changed = F.when(F.col("event_id") % 97 == 5, F.concat(value, F.lit("!"))).otherwise(value)
    second = e.select("event_id", F.lit(1).cast("long").alias("seq"), changed.alias("payload"), sealed(F.lit(""), user).alias("previous"), sealed(sealed(F.lit(""), user), value).alias("digest"))
    return broken_links(first.unionByName(second), "seq", "payload", "previous", "digest", ("event_id",)).select("event_id", "seq")
