"""Joins with contracts, unions and merge rules, acceptance of whole groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import unique_or_fail


def checked(ok: Column, message: str) -> Column:
    """True, or the job fails: for filters."""
    return F.when(F.coalesce(ok, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def _renamed(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(keys, names, strict=True)))


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Every left row once, with the right row of its key or nulls. The job fails on a key that repeats on either side; null keys meet nothing. Rows keep their own ordinal columns, as tables have no order."""
    return unique_or_fail(left, keys).join(unique_or_fail(right, keys), keys, "left").select(*left.columns, *[c for c in right.columns if c not in keys])


def reindex(index: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Values aligned to the keys of ``index``, which may repeat; keys without values have nulls. The job fails on a repeated key of ``values``."""
    return index.select(*keys).join(unique_or_fail(values, keys), keys, "left")


def replace_columns(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The base with all columns of ``new`` in place of its own of that name; rows that ``new`` lacks get nulls there, not the old values."""
    over = [c for c in new.columns if c not in keys]
    return base.drop(*over).join(unique_or_fail(new, keys), keys, "left")


def equal_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A one-to-one merge of two tables with the same keys, no shared column and only finite numbers; the job fails on anything else."""
    if both := sorted((set(left.columns) & set(right.columns)) - set(keys)):
        raise ValueError(f"columns on both sides: {both}")
    a = unique_or_fail(left, keys).withColumn("in left", F.lit(True))
    b = unique_or_fail(right, keys).withColumn("in right", F.lit(True))
    out = a.join(b, keys, "full").where(checked(F.col("in left") & F.col("in right"), "keys differ"))
    numbers = [f.name for f in out.schema if f.dataType.simpleString() in ("double", "float") and f.name not in keys]
    for c in numbers:
        out = out.where(checked(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")), f"{c} is not finite"))
    return out.drop("in left", "in right")


def shared_candidates(sources: list[DataFrame], fallback: DataFrame, key: str, candidate: str) -> DataFrame:
    """(key, candidate): for each key, the candidates that all sources having any agree on; the fallback's only where no source has any."""
    rows = reduce(DataFrame.unionByName, [s.select(key, candidate, F.lit(i).alias("source")).distinct() for i, s in enumerate(sources)])
    having = rows.groupBy(key).agg(F.count_distinct("source").alias("sources"))
    agreed = rows.groupBy(key, candidate).agg(F.count(F.lit(1)).alias("by")).join(having, key).where("by = sources").select(key, candidate)
    return agreed.unionByName(fallback.select(key, candidate).distinct().join(having, key, "left_anti"))


def union_columns(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column that a frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def newer_block(base: DataFrame, change: DataFrame, key: str, season: str, sample: str, level: str, share: float = 0.6, ahead: int = 2) -> DataFrame:
    """The base with a row's (season, sample, level) replaced as a block, and ``action``: insert where the base has none; replace if the new season is later and its sample at least ``share`` of the old one, or the season ``ahead`` later; or if a level of 1 gives way to a higher one; else keep."""
    c = change.select(F.col(key).alias("new key"), *[F.col(x).alias(f"new {x}") for x in (season, sample, level)])
    j = base.join(unique_or_fail(c, ["new key"]), base[key] == F.col("new key"), "left")
    new = lambda x: F.col(f"new {x}")
    later = (new(season) > F.col(season)) & ((F.coalesce(new(sample), F.lit(0)) >= share * F.coalesce(F.col(sample), F.lit(0))) | (new(season) - F.col(season) >= ahead))
    action = F.when(new(season).isNull(), "keep").when(F.col(season).isNull(), "insert").when(later | ((F.col(level) == 1) & (new(level) > 1)), "replace").otherwise("keep")
    j = j.withColumn("action", action)
    taken = F.col("action") != "keep"
    return j.select(*[F.when(taken, new(c)).otherwise(F.col(c)).alias(c) if c in (season, sample, level) else F.col(c) for c in base.columns], "action")


def recomputed(df: DataFrame, derived: dict[str, Column], defaults: dict[str, object]) -> DataFrame:
    """After a merge: flags that are null get their defaults, then derived columns are computed anew from what stands now."""
    return df.fillna(defaults).withColumns(derived)


def in_every_partition(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(partition, column, filled): how many values each partition has of each column, which all of them must own; a column that the table lacks fails."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    counts = df.groupBy(by).agg(*[F.count(c).alias(c) for c in columns])
    return counts.select(by, F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("filled")) for c in columns])).alias("x")).select(by, "x.*")


def last_written(df: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Of each field the last value that isn't null, in one aggregate."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in fields])


def union_keeping(frames: list[DataFrame], keys: list[str], order: list[str], last: bool = True) -> DataFrame:
    """The frames' rows, one for each key: of the last frame (or the first) that has it, and there the last (first) by ``order``."""
    rows = reduce(DataFrame.unionByName, [f.withColumn("frame", F.lit(i)) for i, f in enumerate(frames)])
    rest = [c for c in frames[0].columns if c not in keys]
    pick = (F.max if last else F.min)(F.struct("frame", *order, F.struct(*rest).alias("row")))
    return rows.groupBy(*keys).agg(pick.alias("x")).select(*keys, *[F.col("x.row")[c].alias(c) for c in rest])


def top_overlap(df: DataFrame, key: str, a: str, b: str, sizes: tuple[int, ...]) -> DataFrame:
    """(k, shared): keys that the k highest by ``a`` and the k highest by ``b`` have in common; ties to smaller keys."""
    most = max(sizes)
    ranked = lambda c, out: df.where(F.col(c).isNotNull()).orderBy(F.desc(c), key).limit(most).select(key, c).withColumn(out, F.row_number().over(Window.orderBy(F.desc(c), key))).select(key, out)
    both = ranked(a, "ra").join(ranked(b, "rb"), key)
    return both.agg(*[F.count_if((F.col("ra") <= k) & (F.col("rb") <= k)).alias(str(k)) for k in sizes]).select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(str(k)).alias("shared")) for k in sizes])).alias("x")).select("x.*")


def disjoint_or_fail(df: DataFrame, key: str, side: str) -> DataFrame:
    """The rows; the job fails on a key that stands on two sides."""
    sides = F.min(side).over(Window.partitionBy(key)) == F.max(side).over(Window.partitionBy(key))
    return df.withColumn("alone", sides).where(checked(F.col("alone"), f"{key} on two sides")).drop("alone")


def wide_quarantine(df: DataFrame, group: str, wider: str, bad: Column) -> Column:
    """Whether a row is refused: its group has a bad row, or its wider group has a bad row that belongs to no group."""
    own = F.max(F.when(bad & F.col(group).isNotNull(), 1).otherwise(0)).over(Window.partitionBy(wider, group))
    wide = F.max(F.when(bad & F.col(group).isNull(), 1).otherwise(0)).over(Window.partitionBy(wider))
    return (F.when(F.col(group).isNull(), 0).otherwise(own) + wide) > 0


def complete_groups(df: DataFrame, keys: list[str], valid: Column, day: str, window: tuple[Column, Column], least: int) -> DataFrame:
    """(keys, n, verdict): a group is accepted whole if no row was refused, it has ``least`` rows and all its days lie in the window; else the first reason."""
    inside = F.col(day).between(*window)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(valid, F.lit(False))).alias("ok"), F.count_if(F.coalesce(inside, F.lit(False))).alias("days"))
    verdict = F.when(F.col("ok") < F.col("n"), "refused rows").when(F.col("n") < least, "too few").when(F.col("days") < F.col("n"), "outside the window").otherwise("accepted")
    return g.select(*keys, "n", verdict.alias("verdict"))


def not_stale(snapshots: DataFrame, actual: DataFrame, snapshot: str, key: str, value: str) -> DataFrame:
    """Rows of snapshots that foretell: one whose every value equals the actual one was taken after the event and goes. Keys without an actual value don't speak for either."""
    a = unique_or_fail(actual.select(F.col(key).alias("actual key"), F.col(value).alias("actual value")), ["actual key"])
    j = snapshots.join(a, snapshots[key] == a["actual key"], "left")
    w = Window.partitionBy(snapshot)
    told, same = F.count("actual value").over(w), F.count_if(F.col(value) == F.col("actual value")).over(w)
    return j.withColumn("stale", (told > 0) & (told == same)).where(~F.col("stale")).select(*snapshots.columns)


def undisputed(labels: DataFrame, entity: str, item: str, label: str) -> DataFrame:
    """(entity, item, label): one item with two labels takes all labels of its entity away."""
    items = labels.where(F.col(label).isNotNull()).groupBy(entity, item).agg(F.min(label).alias(label), (F.min(label) != F.max(label)).cast("int").alias("differs"))
    broken = items.groupBy(entity).agg(F.max("differs").alias("broken")).where("broken = 1")
    return items.drop("differs").join(broken, entity, "left_anti").select(entity, item, label)


def without_labels(df: DataFrame, forbidden: tuple[str, ...]) -> DataFrame:
    """The rows for the public; refuses a column whose name has a forbidden word, at any depth."""
    def names(kind, at: str = "") -> list[str]:
        inner = getattr(kind, "elementType", None) or getattr(kind, "valueType", None)
        return ([f"{at}{f.name}" for f in kind] + [n for f in kind for n in names(f.dataType, f"{at}{f.name}.")]) if hasattr(kind, "fieldNames") else names(inner, at) if inner is not None else []

    if found := [n for n in names(df.schema) if any(w in n.rpartition(".")[2].lower() for w in forbidden)]:
        raise ValueError(f"labels in the output: {found}")
    return df
