"""Contracts, quarantine, patches and tiered matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reasons(*rules: tuple[Column, str]) -> Column:
    """Codes of the rules that a row breaks, in order; a rule that can't be decided counts as broken."""
    return F.array_compact(F.array(*[F.when(F.coalesce(ok, F.lit(False)), None).otherwise(code) for ok, code in rules]))


def quarantine(df: DataFrame, group: list[str], bad: Column) -> Column:
    """Whether any member of the row's group is bad: groups are accepted or refused whole."""
    return F.max(F.when(bad, 1).otherwise(0)).over(Window.partitionBy(*group)) == 1


def unused(name: str, *frames: DataFrame) -> str:
    """A name for a working column that no frame has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def unique_or_fail(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows; the job fails on a key that occurs twice."""
    n = unused("_n", df)
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn(n, times).where(F.when(F.col(n) > 1, F.raise_error(F.lit(f"duplicate key over {keys}")).cast("boolean")).otherwise(True)).drop(n)


def patch(base: DataFrame, change: DataFrame, key: str, protected: tuple[str, ...] = ()) -> DataFrame:
    """Cell updates: missing or empty keeps, "NA" sets null, a number overwrites; new columns are created, protected ones refused."""
    if broken := [c for c in change.columns if c in protected]:
        raise ValueError(f"protected columns: {broken}")
    new = {x: unused(f"new {x}", base, change) for x in change.columns}
    c = change.select(*[F.col(x).alias(n) for x, n in new.items()])
    joined = base.join(c, base[key] == c[new[key]], "left")
    out = []
    for x in [*base.columns, *[x for x in change.columns if x not in base.columns]]:
        if x == key or x not in new:
            out.append(base[x])
            continue
        p = c[new[x]]
        kind = base.schema[x].dataType if x in base.columns else "double"
        old = base[x] if x in base.columns else F.lit(None).cast(kind)
        out.append(F.when(p.isNull() | (p == ""), old).when(p == "NA", None).otherwise(p.try_cast(kind)).alias(x))
    return joined.select(*out)


def only_one(df: DataFrame, *keys: list[str]) -> DataFrame:
    """Rows that are alone with each of the keys: one-to-one on both sides or nothing."""
    n = unused("_n", df)
    for k in keys:
        df = df.withColumn(n, F.count(F.lit(1)).over(Window.partitionBy(*k))).where(F.col(n) == 1).drop(n)
    return df


def normalised(name: Column) -> Column:
    """A name as a key: Latin accents folded, lower case, without punctuation and generation suffixes, single spaces."""
    accents, plain = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ", "aaaaaaeeeeiiiiooooouuuuncyy"
    x = F.translate(F.lower(name), accents, plain)
    x = F.regexp_replace(x, r"[^a-z0-9 ]+", " ")
    x = F.regexp_replace(x, r"\b(jr|sr|ii|iii|iv)\b", " ")
    return F.trim(F.regexp_replace(x, r" +", " "))


def sorted_tokens(name: Column) -> Column:
    return F.array_join(F.array_sort(F.split(normalised(name), " ")), " ")


def tiered(candidates: DataFrame, left: str, right: str) -> DataFrame:
    """(left, tier, right or null, status) of candidates (left, right, tier): the first tier that has any decides; if it has several, the match is ambiguous and nothing is guessed."""
    best = candidates.groupBy(left, "tier").agg(F.count_distinct(right).alias("n"), F.min(right).alias("r"))
    first = best.withColumn("_t", F.row_number().over(Window.partitionBy(left).orderBy("tier"))).where("_t = 1")
    return first.select(left, "tier", F.when(F.col("n") == 1, F.col("r")).alias(right), F.when(F.col("n") == 1, "matched").otherwise("ambiguous").alias("status"))


def one_swap(a: Column, b: Column) -> Column:
    """Whether two different texts of equal length differ by one swap of neighbours."""
    swapped = lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.char_length(a)))
    places = F.when((F.char_length(a) > 1) & (F.char_length(a) == F.char_length(b)) & (a != b), F.sequence(F.lit(1), F.char_length(a) - 1))
    return F.coalesce(F.exists(places, lambda i: swapped(i) == b), F.lit(False))


def clashes(candidates: DataFrame, seen: DataFrame, a: str, b: str, who: str, where: str) -> DataFrame:
    """Candidate pairs (a, b) that occur in one place together, so are two: equi-joins on the candidates' keys, never all pairs of a place."""
    x, y = seen.select(F.col(who).alias(a), where).distinct(), seen.select(F.col(who).alias(b), where).distinct()
    return candidates.join(x, a).join(y, [b, where], "left_semi").select(a, b).distinct()
