"""Fits, matching and markup on fixtures, against brute force where SQL has no form for them."""

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelspark.operators import fits, matching
from panelspark.plans import catalog
from panelspark.sources import markup

SF = "/root/testdata/sf0.001"


def test_expanding_cubic_against_polyfit(spark):
    g = np.random.default_rng(5)
    x = g.integers(180, 260, 400) / 10
    rows = pd.DataFrame({"i": range(400), "c": [2000 + i % 4 for i in range(400)], "x": x, "y": 3 + x - 0.02 * x**2 + 0.001 * x**3 + g.normal(0, 1, 400)})
    df = spark.createDataFrame(rows).unionByName(spark.createDataFrame([(900, None, 20.0, 1.0), (901, 2003, None, 1.0), (902, 2003, 20.0, None)], "i long, c long, x double, y double"))
    got = fits.expanding_cubic(df, "c", "x", "y", 22.0, 4.0, 100, (0.005, 0.995)).toPandas().set_index("i")
    for c in (2000, 2001, 2002, 2003):
        past, own = rows[rows.c < c], rows[rows.c == c]
        if len(past) < 100:
            assert got.loc[own.i, "z"].isna().all()
            continue
        k = np.polyfit(past.x, past.y, 3)
        lo, hi = past.x.quantile([0.005, 0.995])
        want = own.y - np.polyval(k, own.x.clip(lo, hi))
        assert np.allclose(got.loc[own.i, "residual"], want, atol=1e-6)
        assert np.allclose(got.loc[own.i, "z"], want / (past.y - np.polyval(k, past.x)).std(), atol=1e-6)
    assert pd.isna(got.loc[900, "expected"]) and pd.isna(got.loc[901, "expected"])
    assert pd.notna(got.loc[902, "expected"]) and pd.isna(got.loc[902, "residual"])
    assert fits.expanding_cubic(df.where("false"), "c", "x", "y", 22.0, 4.0, 100, (0.005, 0.995)).count() == 0


def test_first_component_without_training_rows_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None)], "a double, b double")
    assert [r["p"] for r in fits.first_component(df, ["a", "b"], [1, 1], 1, "p", F.lit(False)).collect()] == [None, None]


def test_ridge_ratings_against_least_squares(spark):
    g = np.random.default_rng(2)
    games = [(s, i, int(a), int(b), float(g.normal(a - b, 20)), int(g.integers(-1, 2))) for s in (1, 2) for i in range(60) for a, b in [g.choice(6, 2, replace=False)]]
    twice = [(s, i, b, a, -m, -h) for s, i, a, b, m, h in games[::3]]
    junk = [(1, 99, 3, 3, 5.0, 0), (1, 98, 0, 1, None, 0), (None, 1, 0, 1, 1.0, 0)]
    df = spark.createDataFrame([*games, *twice, *junk], "s int, g int, t int, o int, m double, h int")
    got = {(r["season"], r["team"]): r["rating"] for r in fits.ridge_ratings(df, "s", "g", "t", "o", "m", "h").collect()}
    for season in (1, 2):
        x, y = [], []
        for s, _, a, b, m, h in games:
            if s == season:
                row = np.zeros(7)
                row[a], row[b], row[6] = 1, -1, h
                x.append(row)
                y.append(np.clip(m, -22, 22))
        x, y = np.array(x), np.array(y)
        r = np.linalg.solve(x.T @ x + np.diag([25.0] * 6 + [1.0]), x.T @ y)[:6]
        assert np.allclose([got[season, t] for t in range(6)], r - r.mean(), atol=1e-4)
    assert len(got) == 12


def test_ridge_query(spark):
    got = catalog.QUERIES["ridge_ratings"](spark, SF).toPandas()
    assert len(got) and np.allclose(got.groupby("season").rating.mean(), 0, atol=1e-5)


def test_cascade(spark):
    c = [(1, "a", False, True), (1, "b", False, True), (2, "a", True, True), (2, "b", False, None), (3, "a", True, False), (4, "a", False, True), (4, "a", False, True), (4, "b", False, False), (5, None, False, True)]
    df = spark.createDataFrame(c, "l int, r string, bad boolean, good boolean")
    got = {r["l"]: (r["r"], r["decided_by"]) for r in matching.cascade(df, "l", "r", [("bad", "reject", F.col("bad")), ("good", "agree", F.col("good"))]).collect()}
    assert got == {1: (None, "ambiguous"), 2: ("b", "sole"), 3: (None, "none left"), 4: ("a", "good")}


def plain_events(rows, tolerances):
    """Events of one key's rows, in order, by the stated rule, without counting repeats beforehand."""
    events = []
    for source, *vs in rows:
        own = [e for e in events if source and e[0] == source]
        gaps = []
        for i, e in enumerate(events):
            d = [abs(a - b) / t for a, b, t in zip(e[1], vs, tolerances) if a is not None and b is not None]
            if not (source and e[0]) and all(abs(a - b) <= t for a, b, t in zip(e[1], vs, tolerances) if a is not None and b is not None):
                gaps.append((sum(d), i))
        to = own[0] if own else events[min(gaps)[1]] if gaps else None
        if to is None:
            events.append([source, vs, 1])
        else:
            to[0], to[1], to[2] = to[0] or source, [b if a is None else a for a, b in zip(to[1], vs)], to[2] + 1
    return [(e[0] or None, *e[1], e[2]) for e in events]


def test_tolerance_clusters(spark):
    g = np.random.default_rng(3)
    pick = lambda v: None if g.random() < 0.3 else float(v)
    rows = [(int(g.integers(4)), int(g.integers(3)), [None, "A", "a", "B", ""][g.integers(5)], pick(g.integers(5)), pick(g.integers(8) / 2)) for _ in range(120)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "k int, o int, s string, u double, v double")
    got = matching.tolerance_clusters(df, ["k"], "o", "s", {"u": 1.0, "v": 0.5}).sort("k", "event_no").collect()
    low = lambda x: (x is not None, 0 if x is None else x)
    for k in range(4):
        own = sorted(((o, (s or "").lower(), u, v) for kk, o, s, u, v in rows if kk == k), key=lambda r: (r[0], r[1], low(r[2]), low(r[3])))
        want = plain_events([r[1:] for r in own], [1.0, 0.5])
        assert [(r["source"], r["u"], r["v"], r["n_rows"]) for r in got if r["k"] == k] == want
    assert matching.tolerance_clusters(df.where("false"), ["k"], "o", "s", {"u": 1.0}).count() == 0


def test_tolerance_events_keep_every_row(spark):
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert catalog.QUERIES["tolerance_events"](spark, SF).agg(F.sum("n_rows")).first()[0] == n


def test_similar(spark):
    names = ["jon smith", "john smith", "jonathan smith", "mary jones", "", None]
    pairs = [(a, b) for a in names for b in names]
    got = {(r["a"], r["b"]) for r in matching.similar(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()}
    assert got == {(a, b) for a, b in pairs if a is not None and b is not None and difflib.SequenceMatcher(None, a, b).ratio() >= 0.85}


def test_similar_names_against_brute_force(spark):
    p = spark.read.parquet(f"{SF}/part.parquet").toPandas()
    want = set()
    for _, g in p.groupby(["p_brand", "p_type", "p_size"]):
        r = sorted(zip(g.p_partkey, g.p_name))
        want |= {(a, b) for i, (a, m) in enumerate(r) for b, n in r[i + 1 :] if difflib.SequenceMatcher(None, m, n).ratio() >= 0.85}
    assert {(r["a"], r["b"]) for r in catalog.QUERIES["similar_names"](spark, SF).collect()} == want


def test_similar_within_compares_names_once(spark):
    names = ["jon smith", "john smith", "mary jones", "mary jonse", "", "tide bait", "diet bait", None]
    rows = [(k, g, x) for k, (g, x) in enumerate((g, x) for _ in range(9) for g in ("g", "h", None) for x in names)] + [(None, "g", "jon smith"), (0, "g", "jon smith")]
    want = sorted((a, b, difflib.SequenceMatcher(None, m, n).ratio()) for a, g, m in rows for b, h, n in rows if None not in (a, b, g, m, n) and g == h and a < b and difflib.SequenceMatcher(None, m, n).ratio() >= 0.85)
    df = spark.createDataFrame(rows, "k long, g string, x string")
    assert sorted((r["a"], r["b"], r["ratio"]) for r in matching.similar_within(df, ["g"], "k", "x").collect()) == want
    assert matching.similar_within(df.where("false"), ["g"], "k", "x").count() == 0


def test_similar_names_of_copies_are_not_compared_again(spark, tmp_path):
    """What reaches Python is the distinct pairs of names, not the pairs of parts."""
    spark.range(400).selectExpr("id AS p_partkey", "IF(id % 2 = 0, 'large ring', 'large rings') AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    compared, ratio = spark.sparkContext.accumulator(0), matching.matching_ratio

    @F.pandas_udf("double")
    def counting(a: pd.Series, b: pd.Series) -> pd.Series:
        compared.add(len(a))
        return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")

    matching.matching_ratio = counting
    try:
        assert catalog.QUERIES["similar_names"](spark, str(tmp_path)).count() == 400 * 399 // 2
    finally:
        matching.matching_ratio = ratio
    assert compared.value <= 8


def test_recipe_blends_tie_equal_totals(spark, tmp_path):
    """Totals of equal prices tie in whatever order they are added; a repeated customer's orders count as often; without any price the value is 0."""
    prices = {1: [0.1, 0.2, 0.3], 2: [0.3, 0.2, 0.1], 3: [None, None, None], 4: [-5.0, 1.0, 1.0], 5: [0.4, 0.15, 0.05], 6: [1e300, 0.1, 0.2], 7: [1e-12, 0.0, 0.0], 8: [float("nan"), 1.0, 1.0]}
    spark.createDataFrame([(k, 0) for k in [*prices, 5]], "c_custkey long, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, x) for k, v in prices.items() for x in v], "o_custkey long, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    # Values: 4 has -3, 3 has 0, 7 has 1e-12, 1 and 2 have 0.6, 5 has 2 * 0.6, 6 has 1e300, 8 is no number; counts: 5 has 6, all others 3.
    value, count = {4: 2, 3: 4, 7: 6, 1: 9, 2: 9, 5: 12, 6: 14, 8: 16}, {k: 16 if k == 5 else 8 for k in prices}
    want = {(name, k): a * count[k] + b * value[k] for name, a, b in (("even", 6, 6), ("count", 9, 3), ("value", 2, 10)) for k in prices}
    got = catalog.QUERIES["recipe_blends"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {(r["recipe"], r["c_custkey"]): r["blend"] for r in got} == want


def test_html_tables(spark):
    page = "<table><tr><th>A &amp; B<th>C</tr><tr><td>1<br>2</td><td>x<table><tr><td>in</td></tr></table>y</td></tr><tr></tr></table><p>no</p><table><td>loose"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, h string")
    got = sorted((r["table_no"], r["parent_no"], r["row_no"], r["is_header"], *r["cells"]) for r in markup.html_tables(df, "k", "h").collect())
    assert got == [(0, None, 0, True, "A & B", "C"), (0, None, 1, False, "1 2", "xy"), (1, 0, 0, False, "in"), (2, None, 0, False, "loose")]


def test_wikitext_tables(spark):
    text = "== Pro ==\n{|\n|+ caption\n! Year !! GP\n|-\n| 2001 || align=right | 7\n|-\n| [[a|b]]\n| {{x|1}}\n|}\n=== Next ===\n{|\n|-\n| 1 || 2\n|}\n| not in a table"
    got = [(r["section"], r["row_no"], r["header"], r["cells"]) for r in markup.wikitext_tables(spark.createDataFrame([(1, text), (2, None)], "k int, t string"), "k", "t").collect()]
    assert got == [("Pro", 0, ["Year", "GP"], ["2001", "7"]), ("Pro", 1, ["Year", "GP"], ["[[a|b]]", "{{x|1}}"]), ("Next", 2, None, ["1", "2"])]


def test_section_tree(spark):
    text = "lead\n== A ==\nx\n=== B ===\ny\n== C ==\nz"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(markup.section_tree(F.col("t"), r"(?m)^(={2,6})\s*(.*?)\s*={2,6}$", 1, 2)).collect()]
    assert [(s["level"], s["path"], s["body"].strip()) for s in got[0]] == [(0, [""], "lead"), (2, ["A"], "x"), (3, ["A", "B"], "y"), (2, ["C"], "z")]
    assert got[1] is None and [(s["level"], s["body"]) for s in got[2]] == [(0, "")]


def test_embedded_object(spark):
    df = spark.createDataFrame([('a data = {"x": "}\\"{", "y": {"z": 1}}; data = {}',), ("data = {broken; data = {\"k\": 2} data = {}",), ("data = [1]",), (None,)], "p string")
    assert [r[0] for r in df.select(markup.embedded_object(F.col("p"), r"data\s*=\s*")).collect()] == ['{"x": "}\\"{", "y": {"z": 1}}', '{"k": 2}', None, None]


def test_labels_of_cells(spark):
    df = spark.createDataFrame([(["A", " a  b ", "a"], ["1", "2", "3"], "guard", [1, 2, 3]), (None, ["7", "8"], "x", [4]), (None, ["9"], None, None)], "h array<string>, c array<string>, b string, v array<int>")
    named = markup.by_header(F.col("h"), F.col("c"), {"a": "one", "a b": "two"}, {2: ["p", "q"]})
    grid = markup.by_banner(F.col("b"), F.col("v"), [("^guard$", ["g", "h"])], ["o"])
    got = [(r[0], r[1]) for r in df.select(named, grid).collect()]
    assert got == [({"one": "1", "two": "2"}, {"g": 1, "h": 2}), ({"p": "7", "q": "8"}, {"o": 4}), (None, None)]
