"""Matching by evidence in turn, by tolerance between measures, and by matching blocks of names."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def cascade(candidates: DataFrame, left: str, right: str, steps: list[tuple[str, str, Column]]) -> DataFrame:
    """(left, right, decided_by) of candidates (left, right, evidence): one aggregate a left key, however many steps.

    A ``reject`` step removes candidates for which its condition holds; an ``agree`` step decides when
    exactly one remaining candidate meets it. What no step decides is decided by ``sole`` if one
    candidate remains, else right is null and decided_by says ``none left`` or ``ambiguous``. A null
    condition doesn't hold; repeated candidates count once; null keys on the right are ignored.
    """
    alive, flags, agree = F.lit(True), [], []
    for i, (label, kind, holds) in enumerate(steps):
        holds = F.coalesce(holds, F.lit(False))
        if kind == "reject":
            alive = alive & ~holds
        elif kind == "agree":
            flags.append((alive & holds).alias(f"_f{i}"))
            agree.append((label, f"_f{i}"))
        else:
            raise ValueError(f"unknown kind of step: {kind}")
    flags.append(alive.alias("_alive"))
    agree.append(("sole", "_alive"))
    rows = candidates.where(F.col(right).isNotNull()).select(F.col(left), F.col(right), *flags)
    # Least and greatest remaining key tell whether there is exactly one, with bounded state.
    of = lambda f: F.when(F.col(f), F.col(right))
    g = rows.groupBy(left).agg(*[x for _, f in agree for x in (F.min(of(f)).alias(f"{f}_lo"), F.max(of(f)).alias(f"{f}_hi"))])
    one = lambda f: F.col(f"{f}_lo") == F.col(f"{f}_hi")
    pick, why = F.when(F.lit(False), F.col("_alive_lo")), F.when(F.lit(False), "")
    for label, f in agree:
        pick, why = pick.when(one(f), F.col(f"{f}_lo")), why.when(one(f), label)
    return g.select(left, pick.alias(right), why.when(F.col("_alive_lo").isNull(), "none left").otherwise("ambiguous").alias("decided_by"))


def tolerance_clusters(df: DataFrame, keys: list[str], order: str, source: str, measures: dict[str, float]) -> DataFrame:
    """Observations of one key as events: (keys, event_no, source, measures, n_rows).

    Rows come by ``order``, then source and measures. A row joins the key's first event of its own source
    (any case); else, of the events where either side has no source and no shared measure differs by more
    than its tolerance, the one least far in sum of differences by tolerance, the earlier in a tie; else
    it starts an event. An event takes what it lacks from rows that join it. Empty sources and null keys
    are values like others, an empty source meaning none.

    Repeats are counted beforehand, and a task holds the events of one key, never its rows.
    """
    names = [*measures]
    source_of = F.lower(F.coalesce(F.col(source).cast("string"), F.lit(""))).alias("_source")
    flat = df.select(*keys, F.col(order).alias("_order"), source_of, *[F.col(m).cast("double").alias(m) for m in names])
    once = flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("_n"))
    dealt = once.repartition(*keys).sortWithinPartitions(*keys, "_order", "_source", *names)
    columns = [*keys, "event_no", "source", *names, "n_rows"]

    def far(event: dict, row: dict) -> float | None:
        total = 0.0
        for m, tolerance in measures.items():
            if event[m] is not None and row[m] is not None:
                gap = abs(event[m] - row[m])
                if gap > tolerance:
                    return None
                total += gap / tolerance
        return total

    def clustered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, events = None, []

        def done() -> pd.DataFrame:
            return pd.DataFrame([[*key, i, e["_source"] or None, *[e[m] for m in names], e["_n"]] for i, e in enumerate(events)], columns=columns)

        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            for row in batch.to_dict("records"):
                own = tuple(row[k] for k in keys)
                if own != key:
                    if events:
                        yield done()
                    key, events = own, []
                said = row["_source"]
                to = next((e for e in events if said and e["_source"] == said), None)
                if to is None:
                    near = [(d, i) for i, e in enumerate(events) if not (said and e["_source"]) and (d := far(e, row)) is not None]
                    to = events[min(near)[1]] if near else None
                if to is None:
                    events.append(row)
                    continue
                to["_n"] += row["_n"]
                to["_source"] = to["_source"] or said
                for m in names:
                    to[m] = row[m] if to[m] is None else to[m]
        if events:
            yield done()

    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = [*[f"`{k}` {kind[k]}" for k in keys], "event_no long", "source string", *[f"`{m}` double" for m in names], "n_rows long"]
    return dealt.mapInPandas(clustered, ", ".join(schema))


@F.pandas_udf(DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the length of matching blocks over both lengths; null with a null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def similar(pairs: DataFrame, a: str, b: str, least: float = 0.85) -> DataFrame:
    """Candidate pairs whose matching ratio reaches ``least``, with it as ``ratio``; lengths alone rule most others out before Python sees them."""
    x, y = F.char_length(a), F.char_length(b)
    may = 2 * F.least(x, y) >= F.lit(least) * (x + y)
    return pairs.where(may).withColumn("ratio", matching_ratio(F.col(a), F.col(b))).where(F.col("ratio") >= least)


def similar_within(df: DataFrame, by: list[str], key: str, name: str, least: float = 0.85) -> DataFrame:
    """(a, b, ratio) of all rows of a block with key a < b whose names' matching ratio, a's name first, reaches ``least``.

    Names are compared by distinct ordered pair that a block has, whatever the number of rows that share
    them; equal names have the ratio 1 uncompared. Keys meet only by names known to be alike, so nothing
    but the result grows with the copies of a name. Null keys, names and blocks have no pairs; repeated
    keys repeat theirs.
    """
    rows = df.select(*by, F.col(key).alias("key"), F.col(name).alias("name")).where(F.col("name").isNotNull())
    names = rows.groupBy(*by, "name").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    pairs = names.select(*by, F.col("name").alias("m"), "lo").join(names.select(*by, F.col("name").alias("n"), "hi"), by).where("lo < hi").select(*by, "m", "n")
    alike = similar(pairs.where("m <> n").select("m", "n").distinct(), "m", "n", least)
    same = pairs.where((F.col("m") == F.col("n")) & (F.lit(least) <= 1)).withColumn("ratio", F.lit(1.0))
    linked = pairs.join(alike, ["m", "n"]).unionByName(same)
    left = linked.join(rows.withColumnsRenamed({"key": "a", "name": "m"}), [*by, "m"])
    return left.join(rows.withColumnsRenamed({"key": "b", "name": "n"}), [*by, "n"]).where("a < b").select("a", "b", "ratio")
