"""Each catalogue query against DuckDB on the smallest tables, and what plans and operators promise."""

import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelspark.operators import panel, quality, values
from panelspark.plans import catalog
from panelspark.streaming import broken_links, daily_counts, insert_absent

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    plain = lambda v: None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else round(float(v), 5) if isinstance(v, (float, int, np.number)) else [*v] if isinstance(v, np.ndarray) else v
    return sorted(str([plain(v) for v in r]) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.execute(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_values(spark):
    x = spark.createDataFrame([("1.5",), ("abc",), ("",), ("NaN",), ("inf",), (None,), ("-0.0",)], "s string")
    assert [r[0] for r in x.select(values.number(F.col("s"))).collect()] == [1.5, None, None, None, None, None, 0.0]
    y = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (9.0, -1.0)], "a double, b double")
    assert [r[0] for r in y.select(values.ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]
    assert [r[0] for r in y.select(values.clip(F.col("a"), 2, 5)).collect()] == [2, 2, None, 5]
    z = spark.createDataFrame([("6-8",), ("0'0\"",), ("x",)], "s string")
    assert [r[0] for r in z.select(values.feet_inches(F.col("s"))).collect()] == [80.0, None, None]
    w = spark.createDataFrame([("2018-19",), ("1999-00",), ("2018/2019",), ("2004",), ("none",)], "s string")
    assert [r[0] for r in w.select(values.season_end(F.col("s"))).collect()] == [2019, 2000, 2019, 2004, None]


def test_as_of_is_strict_and_blind_to_the_future(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    cuts = spark.createDataFrame([("a", day(10)), ("b", day(10))], "k string, cut timestamp_ntz")
    facts = [("a", day(3), 1, 1.0), ("a", day(9), 2, 2.0), ("a", day(10), 3, 3.0), ("c", day(1), 4, 4.0)]
    schema = "k string, ts timestamp_ntz, id int, v double"
    run = lambda f: sorted((r["k"], r["v"]) for r in panel.as_of(spark.createDataFrame(f, schema), cuts, ["k"], "ts", "cut", 5, "id").collect())
    assert run(facts) == [("a", 2.0), ("b", None)] == run([*facts, ("a", day(99), 5, 9.0), ("b", day(10), 6, 9.0)])


def test_contracts(spark):
    d = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        quality.unique_or_fail(d, ["k"]).collect()
    base = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0)], "pid string, a double")
    change = spark.createDataFrame([("x", "NA"), ("y", ""), ("z", "7")], "pid string, a string")
    assert sorted(map(tuple, quality.patch(base, change, "pid").collect())) == [("x", None), ("y", 2.0), ("z", 7.0)]
    with pytest.raises(ValueError, match="protected"):
        quality.patch(base, change, "pid", ("a",))


def test_group_statistics(spark):
    x = spark.createDataFrame([("g", 1.0), ("g", 3.0), ("g", None), ("h", 5.0)], "g string, x double")
    from pyspark.sql import Window

    got = x.select("g", "x", panel.leave_one_out_mean(F.col("x"), Window.partitionBy("g")).alias("o"), panel.percent_rank(F.col("x"), "g").alias("p")).collect()
    assert sorted((r["g"], str(r["x"]), r["o"], r["p"]) for r in got) == [("g", "1.0", 3.0, 0.5), ("g", "3.0", 1.0, 1.0), ("g", "None", 2.0, None), ("h", "5.0", None, 1.0)]


def test_plans(spark):
    plan = catalog.QUERIES["q01_loo_peer_rate"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "l_tax" not in plan  # columns are pruned at the scan


def test_stream_equals_table(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type", "value")
    stream = spark.readStream.schema(events.schema).parquet(f"{SF}/events*.parquet")
    q = daily_counts(stream).writeStream.outputMode("complete").format("memory").queryName("daily").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("daily").toPandas()) == rows(daily_counts(events).toPandas())


def test_sink_is_idempotent(spark, tmp_path):
    write, at = insert_absent(f"{tmp_path}/out", "k"), f"{tmp_path}/out"
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    write(batch, 0)
    write(batch, 0)
    write(spark.createDataFrame([(2, "c"), (3, "d"), (None, "m")], "k int, v string"), 1)
    write(batch, 0)
    assert sorted(map(tuple, spark.read.parquet(at).select("k", "v").collect()), key=str) == [(1, "a"), (2, "b"), (3, "d"), (None, "n")]


def test_ledger(spark):
    import hashlib

    log, before = [], ""
    for i in range(4):
        now = hashlib.sha256(f"{before}p{i}".encode()).hexdigest()
        log.append((i, f"p{i}", before, now))
        before = now
    schema = "i int, payload string, previous string, digest string"
    assert broken_links(spark.createDataFrame(log, schema), "i", "payload", "previous", "digest").count() == 0
    gap = spark.createDataFrame(log[:1] + log[2:], schema)
    assert [r["i"] for r in broken_links(gap, "i", "payload", "previous", "digest").collect()] == [2]
    log[2] = (2, "forged", *log[2][2:])
    assert [r["i"] for r in broken_links(spark.createDataFrame(log, schema), "i", "payload", "previous", "digest").collect()] == [2]


def test_repair_encoding(spark):
    good = ["naïve café", "plain", "Đorđe", "", None, "ÿ alone"]
    broken = [t if t is None else t.encode().decode("latin-1").encode().decode("latin-1") for t in good]
    df = spark.createDataFrame([(i, b, g) for i, (b, g) in enumerate(zip(broken, good, strict=True))], "i int, b string, g string")
    assert [r[0] for r in df.orderBy("i").select(values.repair_encoding(F.col("b"))).collect()] == good
    assert [r[0] for r in df.orderBy("i").select(values.repair_encoding(F.col("g"))).collect()] == good


def test_dates_that_cannot_be(spark):
    df = spark.createDataFrame([(0, "February 30, 2019"), (1, None), (2, "no date"), (3, "Sept. 2021")], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(values.prose_date(F.col("t")).cast("string")).collect()] == [None, None, None, "2021-09-01"]
