"""What merges, sources and cohort operators refuse, and how they treat nulls, ties and empty tables."""

import pytest
from pyspark.sql import functions as F

from panelspark import functions as fn
from panelspark import sources
from panelspark.operators import cohorts, graph, identity, merging, panel, values


def test_merges_refuse(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, x double")
    b = spark.createDataFrame([(1, 3.0), (3, 4.0)], "k int, y double")
    with pytest.raises(Exception, match="keys differ"):
        merging.equal_keys(a, b, ["k"]).collect()
    with pytest.raises(Exception, match="not finite"):
        merging.equal_keys(a, b.select(F.when(F.col("k") == 3, 2).otherwise(1).alias("k"), F.lit(float("nan")).alias("y")), ["k"]).collect()
    with pytest.raises(ValueError, match="both sides"):
        merging.equal_keys(a, a, ["k"])
    with pytest.raises(Exception, match="duplicate key"):
        merging.one_to_one(a.union(a), b, ["k"]).collect()
    with pytest.raises(Exception, match="two sides"):
        merging.disjoint_or_fail(spark.createDataFrame([(1, "a"), (1, "b")], "k int, side string"), "k", "side").collect()
    with pytest.raises(ValueError, match="labels"):
        merging.without_labels(spark.createDataFrame([(1, (2,))], "k int, s struct<is_toxic: int>"), ("toxic",))
    with pytest.raises(ValueError, match="missing"):
        merging.in_every_partition(a, "k", ["z"])
    assert sorted(map(tuple, merging.one_to_one(a, b, ["k"]).collect())) == [(1, 1.0, 3.0), (2, 2.0, None)]
    assert merging.equal_keys(a.limit(0), b.limit(0), ["k"]).count() == 0


def test_stale_snapshots_go(spark):
    s = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 10), ("b", 2, 21), ("c", 9, 1)], "snapshot string, k int, v int")
    actual = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    assert sorted({r["snapshot"] for r in merging.not_stale(s, actual, "snapshot", "k", "v").collect()}) == ["b", "c"]


def test_sources(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,a\n2\n3,c\n")
    rows, refused = sources.read_csv(spark, str(tmp_path / "x.csv"), "k int, v string", header=False, width=2)
    assert [r["k"] for r in rows.orderBy("k").collect()] == [1, 3] and [r[0] for r in refused.collect()] == ["2"]
    with pytest.raises(Exception, match="wrong width"):
        sources.read_csv(spark, str(tmp_path / "x.csv"), "k int, v string", header=False, width=2, refuse=True)[0].collect()
    with pytest.raises(ValueError, match="has changed"):
        sources.pinned(spark, str(tmp_path / "x.csv"), "0" * 64)
    with pytest.raises(ValueError, match="not read as text"):
        sources.append_columns(spark.range(2), spark.range(2), "id")
    (tmp_path / "sheet.txt").write_text("note\nB, A\n1,2\n3\n")
    got = sources.below_header(sources.lines_of(spark, str(tmp_path / "sheet.txt")), F.col("line").contains("B"), ["A", "B", "C"])
    assert [(r["A"], r["B"], r["C"]) for r in got.collect()] == [("2", "1", None)]


def test_keys_of_names(spark):
    df = spark.createDataFrame([("William \"Bill\" J. Smith Jr.",), ("Cher",), (None,), ("",)], "n string")
    got = [{x["tier"]: x["key"] for x in r[0]} for r in df.select(identity.key_variants(F.col("n"), {"william": "will"})).collect()]
    assert got == [{1: "william j smith", 2: "will j smith", 3: "bill j smith", 4: "william smith", 5: "w smith", 6: "williamjsmith", 7: "will smith"}, {1: "cher"}, {}, {}]


def test_prose_and_calendar(spark):
    df = spark.createDataFrame([("Projected to go no. 12, a top-10 pick",), ("nothing",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.smallest_pick(F.col("t"))).collect()] == [10, None, None]
    assert [r[0] for r in spark.createDataFrame([("Group VIII",), ("tier 3 (II)",), ("mix",), (None,)], "t string").select(fn.tier_number(F.col("t"))).collect()] == [8.0, 3.0, None, None]
    assert [str(r[0]) for r in spark.createDataFrame([(2018,), (2024,)], "y int").select(fn.marked_sunday(F.col("y"))).collect()] == ["2018-03-11", "2024-03-17"]


def test_ranks_without_one_task(spark):
    import random

    rng = random.Random(1)
    rows = [(i, rng.choice([None, *range(40)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v int")
    known = [v for _, v in rows if v is not None]
    got = {r["v"]: (r["less"], r["ties"]) for r in panel.standing(df, "v", 7).collect()}
    assert got == {v: (sum(x < v for x in known), known.count(v)) for v in set(known)}
    assert panel.standing(df.limit(0), "v").count() == 0


def test_components_and_deletions(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 51), (51, 52), (7, 7), (None, 3)], "a long, b long")
    assert {r["node"]: r["root"] for r in graph.components(edges).collect()} == {i: 1 for i in range(1, 31)} | {i: 50 for i in (50, 51, 52)}
    assert sorted(spark.createDataFrame([("abc",)], "t string").select(values.deletions(F.col("t"))).first()[0]) == ["a", "ab", "abc", "ac", "b", "bc", "c"]


def test_later_rows_never_change_earlier_results(spark):
    """Temporal operators on a table, and on it with rows of later cohorts added."""
    rows = [(k, 2000 + k % 4, float(s), float(k * s % 7)) for k in range(24) for s in range(3)]
    later = [*rows, *[(100 + k, 2009, float(s), 99.0 * s) for k in range(5) for s in range(3)]]
    schema = "k int, cohort int, x double, y double"
    run = lambda r: {x["k"]: (x["slope"], x["shrunk"]) for x in cohorts.shrunk_slopes(spark.createDataFrame(r, schema), "k", "cohort", "x", "y").collect() if x["k"] < 100}
    assert run(rows) == run(later)
    fold = lambda r: cohorts.walk_forward(spark.createDataFrame(r, schema).withColumn("s", F.col("cohort") + F.col("x").cast("int")), spark.createDataFrame([(2003,), (2004,)], "test_year int"), "cohort", "s").count()
    assert fold(rows) == fold(later) > 0
