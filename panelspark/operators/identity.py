"""Who is who: alternate keys, tiers that fall through, evidence of dates and ages, surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import normalised


def key_variants(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """array<struct<tier, key>> of a name: 1 as it is, 2 with the first name's alias, 3 with a quoted nickname as first name, 4 without middle names, 5 initial and last name, 6 without spaces, 7 four letters of the first name and the last. Variants that a name doesn't have are left out; explode and join on (tier, key)."""
    plain = normalised(F.regexp_replace(name, r"[\"'\u201c][^\"'\u201d]+[\"'\u201d]", " "))
    nick = normalised(F.regexp_extract(name, r"[\"\u201c]([^\"\u201d]+)[\"\u201d]", 1))
    words = F.split(plain, " ")
    first, last, rest = F.get(words, F.lit(0)), F.element_at(words, -1), F.array_join(F.slice(words, 2, F.size(words)), " ")
    several = F.size(words) > 1
    other = F.try_element_at(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]), first) if aliases else F.lit(None).cast("string")
    variants = [
        (1, F.when(plain != "", plain)), (2, F.when(several & other.isNotNull(), F.concat_ws(" ", other, rest))), (3, F.when(several & (nick != ""), F.concat_ws(" ", nick, rest))),
        (4, F.when(F.size(words) > 2, F.concat_ws(" ", first, last))), (5, F.when(several, F.concat_ws(" ", F.substring(first, 1, 1), last))),
        (6, F.when(several, F.array_join(words, ""))), (7, F.when(several & (F.char_length(first) > 4), F.concat_ws(" ", F.substring(first, 1, 4), last))),
    ]
    return F.array_compact(F.array(*[F.when(k.isNotNull(), F.struct(F.lit(t).alias("tier"), k.alias("key"))) for t, k in variants]))


def first_plausible(candidates: DataFrame, left: str, right: str, tier: str, plausible: Column) -> DataFrame:
    """(left, tier, right, status): a tier without a plausible candidate falls through to the next; the first that has one decides, and stops as ambiguous if it has several. Without any: no tier, "none"."""
    best = candidates.groupBy(left, tier).agg(F.count_distinct(F.when(plausible, F.col(right))).alias("n"), F.min(F.when(plausible, F.col(right))).alias("r"))
    first = best.groupBy(left).agg(F.min(F.when(F.col("n") > 0, F.struct(tier, "n", "r"))).alias("x"))
    status = F.when(F.col("x").isNull(), "none").when(F.col("x.n") == 1, "matched").otherwise("ambiguous")
    return first.select(left, F.col("x")[tier].alias(tier), F.when(F.col("x.n") == 1, F.col("x.r")).alias(right), status.alias("status"))


def age_consistent(candidates: DataFrame, left: str, right: str, expected: Column, found: Column, within: float = 2.5) -> DataFrame:
    """(left, right): the only candidate whose age lies within the tolerance; with two or none, nothing."""
    near = candidates.where(F.abs(expected - found) <= within)
    return near.groupBy(left).agg(F.count_distinct(right).alias("n"), F.min(right).alias(right)).where("n = 1").select(left, right)


def consistent(df: DataFrame, key: str, evidence: str) -> DataFrame:
    """Rows of keys on whose evidence all that is known agrees; keys in conflict go whole."""
    told = df.groupBy(key).agg(F.min(evidence).alias("least"), F.max(evidence).alias("most")).where("least != most")
    return df.join(told, key, "left_anti")


def surrogate(*parts: Column, length: int = 16) -> Column:
    """An id from a tuple: the head of a SHA-256 of its parts, each with its length, so that no two tuples write alike; null is told from empty."""
    text = [F.coalesce(F.concat(F.char_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts]
    return F.substring(F.sha2(F.concat_ws(",", *text), 256), 1, length)


def date_agreement(a: Column, b: Column, days: int = 2) -> Column:
    """"same", "close" (up to ``days`` apart), "swapped" (day and month), "month" (same month), "year", "differ"; null if either is."""
    swapped = (F.year(a) == F.year(b)) & (F.month(a) == F.dayofmonth(b)) & (F.dayofmonth(a) == F.month(b))
    year = F.year(a) == F.year(b)
    return F.when(F.to_date(a) == F.to_date(b), "same").when(F.abs(F.datediff(a, b)) <= days, "close").when(swapped, "swapped").when(year & (F.month(a) == F.month(b)), "month").when(year, "year").when(a.isNotNull() & b.isNotNull(), "differ")
