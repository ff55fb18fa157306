"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Targets: sources ordered by code point (null last) weigh 5, 2, 1, repeating, and share the words of
all documents; a target stops at ``cap`` times its source's size and the excess is shared again by
weight. That fixed point is a water level: target = min(cap * size, level * weight).

Allocation: blocks of ``block`` words go to sources by the highest quotients target / (2k + 1), then
each source's blocks go to its shards by the same rule, with the shards' words as votes. The selection
of blocks is seeded: a shard's documents stand in seeded order as one stream of words; its quota takes
whole passes over the stream and the first words of one more pass, a contiguous run of blocks.

Scale: everything is aggregated to (source, shard) before a window sees it. A source's shards number
its documents / ``shard_docs``, so that the per-shard window, the only one over documents, holds about
``shard_docs`` rows however hot a source is. Candidate quotients per source are bounded (see
``apportion``): their count follows the number of sources, not of blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, n_words

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 32
SHARD_DOCS = 4096
SEED = "mix-1"


def uniform(*parts: Column) -> Column:
    """A seeded number of 32 bits that SQL engines agree on: the head of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def targets(sources: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, docs) -> the same with weight and target.

    A source is capped when cap * size <= level * weight. By the ratio size / weight ascending, the
    capped ones come first: the level of the rest is (total - capped) / (weights of the rest), and
    the first source whose ratio exceeds it ends the capped run.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.lit(0)
    for i, x in enumerate(weights):
        w = F.when(F.col("place") % len(weights) == i, F.lit(x)).otherwise(w)
    by_ratio = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sources.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", w.cast("long"))
        .withColumn("ratio", F.col("source_size") * F.lit(float(cap)) / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum(F.col("source_size") * cap).over(by_ratio), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("before")) / F.sum("weight").over(rest).cast("double"))
        .withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "place", "level"))).over(everything)["level"])
        .withColumn("target", F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("source_size") * F.lit(float(cap))).otherwise(F.col("level") * F.col("weight")))
        .select("source", "source_size", "docs", "target")
    )


def apportion(df: DataFrame, group: list[str], votes: str, seats: str, tie: list[str], out: str) -> DataFrame:
    """Adds ``out``: seats of each row by Sainte-Laguë within its group.

    With n rows and S seats in a group, the divisor that hands out S seats lies between the ones that
    hand out at least and at most S, as rounding errs by half a seat a row: a row with share p has
    between p(S - n/2) - 1/2 and p(S + n/2) + 1/2 seats. The lower bound is given at once; only the
    quotients between the bounds, under p*n + 3 a row and 4n a group, are ranked.
    """
    g = Window.partitionBy(*group)
    p = F.col(votes) / F.col("_v")
    base = (
        df.withColumn("_v", F.sum(votes).over(g).cast("double"))
        .withColumn("_n", F.count(F.lit(1)).over(g))
        .withColumn("_lo", F.when(F.col("_v") > 0, F.greatest(F.lit(0.0), F.floor(p * (F.col(seats) - F.col("_n") / 2) - 0.5))).otherwise(0.0).cast("long"))
        .withColumn("_hi", F.when(F.col("_v") > 0, F.ceil(p * (F.col(seats) + F.col("_n") / 2) + 1.5)).otherwise(0.0).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_lo").over(g))
    )
    k = base.withColumn("_k", F.explode(F.sequence(F.col("_lo"), F.greatest(F.col("_hi"), F.col("_lo")))))
    order = Window.partitionBy(*group).orderBy(F.desc(F.col(votes) / (F.col("_k") * 2 + 1)), *tie)
    ranked = k.withColumn("_won", (F.row_number().over(order) <= F.col("_left")) & (F.col(votes) > 0))
    keep = [c for c in df.columns]
    return (
        ranked.groupBy(*keep, "_lo").agg(F.sum(F.col("_won").cast("long")).alias("_extra")).withColumn(out, F.col("_lo") + F.col("_extra")).select(*keep, out)
    )


def mix(docs: DataFrame, block: int = BLOCK, cap: int = CAP, shard_docs: int = SHARD_DOCS, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the row's shard and place in its stream.

    Nulls: a null text has size 0; a null source is a source of its own, ordered last; a null doc_id
    is seeded as the empty text. Repeated rows are rows of their own: ties in the seeded order stand
    by doc_id and size, so that equal rows may swap places but not amounts. Empty texts take nothing.
    An empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_key"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).cast("long").alias("size"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")), cap, weights)
    total = Window.partitionBy()
    quota = apportion(
        sources.withColumn("_all", F.lit(0)).withColumn("_seats", F.round(F.sum("target").over(total) / block).cast("long")).withColumn("n_shards", F.ceil(F.col("docs") / shard_docs)),
        ["_all"], "target", "_seats", ["source"], "_blocks",
    ).select("source", "source_size", "target", "n_shards", "_blocks")
    q = quota.withColumnRenamed("source", "_source")
    placed = rows.join(q, rows["source"].eqNullSafe(q["_source"])).drop("_source").withColumn("shard", F.pmod(uniform(F.lit(seed), F.lit("shard"), key), F.col("n_shards")))
    shards = apportion(
        placed.groupBy("source", "shard", "_blocks").agg(F.sum("size").alias("_words")), ["source"], "_words", "_blocks", ["shard"], "_quota",
    ).select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "_words", "_quota")
    joined = placed.join(shards, placed["source"].eqNullSafe(shards["_source"]) & (placed["shard"] == shards["_shard"])).drop("_source", "_shard")
    stream = Window.partitionBy("source", "shard").orderBy(uniform(F.lit(seed), F.lit("order"), key), "doc_id", "size")
    words = F.least(F.col("_quota") * block, F.col("_words") * cap)
    some = F.nullif(F.col("_words"), F.lit(0).cast("long"))  # ANSI mode forbids zero as a divisor
    rest = F.pmod(words, some)
    return (
        joined.withColumn("_end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("taken", F.when(F.col("_words") > 0, F.floor(words / some) * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("_end") - F.col("size"))))).otherwise(0).cast("long"))
        .select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "source", "shard", "text_key")
    )


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix as documents: each stands taken // size times whole, then once with its first words for the rest.

    Rows meet by doc_id and text, so equal rows must be gone before. Null ids meet null ids; a document
    that the mix takes nothing of, so one without words, is dropped; an empty table gives no rows. The
    first words of a cut document keep the white space between them. Other columns, whatever their
    names, travel in one struct; a column n_chars is counted anew.
    """
    m = mixed.where("taken > 0").select(F.col("doc_id").alias("at"), F.col("text_key").alias("at_key"), "size", "taken")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    # Up to the end of the last word taken: what stands before it, with a code point of white space after each piece.
    place = F.element_at(F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), lambda i: F.get(F.col("pieces"), i) != ""), rest)
    length = F.aggregate(F.slice("pieces", 1, place), F.lit(0), lambda n, x: n + F.char_length(x) + 1) + F.char_length(F.get(F.col("pieces"), place))
    head = F.substring("row.text", F.lit(1), length)
    parts = F.concat(F.array_repeat(F.col("row.text"), whole), F.when(rest > 0, F.array(head)).otherwise(F.array().cast("array<string>")))
    joined = rows.join(m, rows["id"].eqNullSafe(m["at"]) & (rows["key"] == m["at_key"])).withColumn("pieces", F.when(rest > 0, F.split(F.col("row.text"), SPACE[:-1])))
    texts = joined.select("row", F.explode(parts).alias("part"))
    of = {"text": F.col("part")} | ({"n_chars": F.char_length("part").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    texts = texts.select("row", F.struct(*[x.alias(c) for c, x in of.items()]).alias("new"))
    return texts.select(*[F.col("new" if c in of else "row").getField(c).alias(c) for c in docs.columns])
