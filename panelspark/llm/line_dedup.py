"""Line deduplication over a corpus: exact lines and lines within one edit, in DataFrame functions only.

A line is what stands between line feeds, trimmed of ASCII white space; blank lines take no part and
always stay. Lines are ordered by (doc_id, hash of the text, line number), null ids first. An
occurrence goes when the same line occurs earlier, or when an earlier line of the corpus is within
edit distance one (insertion, deletion or substitution of a code point), whatever their length. A
line that goes still counts as an earlier line.

Method: deletion neighbourhood. A line's variants are what is left after deleting one code point.
Two lines of equal length are one substitution apart if they share a variant with the same place of
deletion; lines of neighbouring lengths are one insertion apart if the shorter is a variant of the
longer. So equal (variant, place) keys are proof, up to hashing, and the least line of a key's group
is an earlier neighbour for all others: a minimum per key replaces pairs.

Emitting a variant per code point of a corpus would multiply it by some ten. One edit leaves the
first or the second half of a line unchanged, so only lines that share a half with another line (of
equal or neighbouring length) emit variants, and only of the other half. No pair is lost by that.
Every found neighbour is verified on the lines themselves: up to one code point after what they begin
with, the rest must agree.

Long halves are cut in segments, about as many as a segment has code points: an edit lies in one of
them, so a variant is the hash of what stands before its segment, of the segment less a code point,
and of what stands after. Before and after are hashed once a segment, so a half of n code points costs
n * sqrt(n), not n * n, and no row holds more than a segment's variants.

Scale: shuffles carry hashes and positions, not texts, but for one join that brings each document its
list of lines to drop. The halves that lines share are eight-byte hashes: where they number at most
``few``, they are broadcast and the second reading of the lines shuffles nothing else; otherwise it joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SEGMENT = 128
FEW = 2_000_000
BLANKS = " \t\r\x0b\x0c"


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line) of the lines that aren't blank."""
    split = F.posexplode(F.split(F.col("text"), "\n", -1)).alias("line_no", "_line")
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), split)
        .select("doc_id", "text_key", "line_no", F.btrim("_line", F.lit(BLANKS)).alias("line"))
        .where("line != ''")
    )


def _halves(n: Column, role: int) -> list[Column]:
    """Keys of a line as one of length ``n``: its halves, by their hash. role 0: it has that length; 1: one more."""
    s = (n / 2).cast("int")
    first, last = F.substring("line", F.lit(1), s), F.substring("line", s + 1 + role, n - s)
    return [F.struct(n.alias("n"), F.lit(side).alias("side"), F.xxhash64(part).alias("half"), F.lit(role).alias("role")) for side, part in ((0, first), (1, last))]


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two texts are at most one insertion, deletion or substitution of a code point apart. Their common head is found by halving steps, so n code points cost n log n; levenshtein() costs n * n."""
    x, y = F.char_length(a), F.char_length(b)
    bits = F.ceil(F.log2((F.least(x, y) + 1).cast("double"))).cast("int")

    def longer(head: Column, k: Column) -> Column:
        step = F.pow(F.lit(2.0), k).cast("int")
        return F.when((head + step <= F.least(x, y)) & (F.substring(a, head + 1, step) == F.substring(b, head + 1, step)), head + step).otherwise(head)

    head = F.aggregate(F.sequence(bits, F.lit(0), F.lit(-1)), F.lit(0), longer)
    rest = lambda n: F.substring(a, n + F.when(x >= y, 2).otherwise(1), x) == F.substring(b, n + F.when(x <= y, 2).otherwise(1), y)
    # The head is bound once, as the only element of an array.
    return (F.abs(x - y) <= 1) & F.exists(F.array(head), rest)


def near_lines(lines: DataFrame, few: int = FEW, segment: int = SEGMENT) -> DataFrame:
    """(h1, h2) of distinct lines of which an earlier line is within one edit."""
    length = F.char_length("line")
    whole, less = _halves(length, 0), _halves(length - 1, 1)
    key = lambda half: F.xxhash64(half["side"], half["half"])
    # Of the four halves two are the same text: the first ones of an odd length, the last ones of an even one.
    three = F.array(key(whole[0]), key(whole[1]), F.when(length % 2 == 1, key(less[1])).otherwise(key(less[0])))
    shared = cut(lines.select("h1", F.explode(three).alias("k")).groupBy("k").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("k"))
    where = ["h1", "h2", "n", "side", "half", "role"]
    at = F.struct("doc_id", "text_key", "line_no", "h1", "h2")
    keyed = lines.select("*", F.explode(F.array(*whole, *less)).alias("x")).select(*lines.columns, "x.*").withColumn("k", F.xxhash64("side", "half"))
    if shared.count() <= few:
        wanted = cut(keyed.join(F.broadcast(shared), "k", "left_semi").groupBy(*where).agg(F.min(at).alias("at"), F.min("line").alias("line")))
    else:
        places = cut(keyed.join(shared, "k", "left_semi").select(*where).distinct())
        texts = lines.join(places.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min(at).alias("at"), F.min("line").alias("line"))
        wanted = cut(places.join(texts, ["h1", "h2"]))
    s = (F.col("n") / 2).cast("int")
    # What stands beside the shared half: the second half for side 0, the first for side 1, with one more code point for role 1.
    other = F.when(F.col("side") == 0, F.substring("line", s + 1, F.col("n") - s + F.col("role"))).otherwise(F.substring("line", F.lit(1), s + F.col("role")))
    # Segments of that, by its length in a line of length n, so that all lines which may meet are cut alike.
    m = F.when(F.col("side") == 0, F.col("n") - s).otherwise(s)
    size = F.when(m <= segment, F.greatest(m, F.lit(1))).otherwise(F.ceil(F.sqrt(m.cast("double"))).cast("int"))
    cut_ = wanted.withColumn("other", other).where(F.char_length("other") > 0).withColumn("m", m).withColumn("size", size)
    begin = lambda k: k * F.col("size")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("m") / F.col("size")).cast("int") - 1, F.lit(0))), lambda k: F.struct(
        k.alias("k"), F.xxhash64(F.substring("other", F.lit(1), begin(k))).alias("pre"), F.xxhash64(F.substring("other", F.least(begin(k + 1), F.col("m")) + F.col("role") + 1, F.col("m") + 1)).alias("post"),
        F.substring("other", begin(k) + 1, F.least(F.col("size"), F.col("m") - begin(k)) + F.col("role")).alias("text"),
    ))
    segments = cut_.select("at", "n", "side", "half", "role", F.explode(parts).alias("g")).select("at", "role", F.xxhash64("n", "side", "half", "g.k", "g.pre", "g.post").alias("around"), F.col("g.text").alias("seg"))
    variant = lambda i: F.xxhash64(F.concat(F.substring("seg", F.lit(1), i), F.substring("seg", i + 2, F.char_length("seg"))))
    places = F.when(F.char_length("seg") > 0, F.sequence(F.lit(0), F.char_length("seg") - 1)).otherwise(F.array().cast("array<int>"))
    # place >= 0: one deleted there from a line of the length itself; -1: the shorter line whole, or the longer one less any code point.
    own = F.concat(F.array(F.struct(F.lit(-1).alias("place"), F.xxhash64("seg").alias("v"))), F.transform(places, lambda i: F.struct(i.alias("place"), variant(i).alias("v"))))
    longer = F.transform(places, lambda i: F.struct(F.lit(-1).alias("place"), variant(i).alias("v")))
    # One hash of all that must agree is the key: rows are small and sort by one number.
    emitted = (
        segments.select("at", "role", "around", F.explode(F.when(F.col("role") == 0, own).otherwise(longer)).alias("x"))
        .select("at", "role", (F.col("x.place") >= 0).alias("placed"), F.xxhash64("around", "x.place", "x.v").alias("k"))
    )
    by_key = Window.partitionBy("k")
    of_length, of_more = F.min(F.when(F.col("role") == 0, F.col("at"))).over(by_key), F.min(F.when(F.col("role") == 1, F.col("at"))).over(by_key)
    earlier = F.when(F.col("placed") | (F.col("role") == 1), of_length).otherwise(of_more)
    found = emitted.withColumn("by", earlier).where("by < at").select("at.h1", "at.h2", F.col("by.h1").alias("b1"), F.col("by.h2").alias("b2")).distinct()
    texts = wanted.select("h1", "h2", "line").distinct()
    other_texts = texts.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("b_line"))
    return found.join(texts, ["h1", "h2"]).join(other_texts, ["b1", "b2"]).where(within_one_edit(F.col("line"), F.col("b_line"))).select("h1", "h2").distinct()


def dropped_lines(docs: DataFrame, few: int = FEW) -> DataFrame:
    """(doc_id, text_key, line_no, near): occurrences that go; near says that an earlier line is within one edit, else equal."""
    lines = lines_of(docs).withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(7), "line"))
    near = cut(near_lines(lines, few))
    bare = lines.select("doc_id", "text_key", "line_no", "h1", "h2")
    # The first occurrence by a minimum with partial sums: a line that a third of all documents share meets in one row per task.
    firsts = bare.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "text_key", "line_no")).alias("first"), F.count(F.lit(1)).alias("times"))
    marked = firsts.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").withColumn("near", F.coalesce("near", F.lit(False)))
    # Lines that occur once and have no neighbour, nearly all, need no second look.
    # A table of its own: the join below then isn't tied to the counts' partitioning, and a line that very many documents share can be split.
    marked = cut(marked.where("times > 1 or near").select("h1", "h2", "first", "near"))
    return bare.join(marked, ["h1", "h2"]).where(F.col("near") | (F.struct("doc_id", "text_key", "line_no") != F.col("first"))).select("doc_id", "text_key", "line_no", "near")


def dedup_lines(docs: DataFrame, few: int = FEW) -> DataFrame:
    """The rows with ``text`` rid of duplicate lines, and n_lines, n_dropped, n_near: lines that aren't blank, those that went, those of them that went as near ones.

    Nulls: a null text has no lines and stays null; a null doc_id orders first. Empty texts stay as
    they are. Repeated rows (equal doc_id and text) are one document: each gets the same result. Ties
    don't occur, as the order is total over different documents. Very long lines: see the module. An
    empty table gives no rows. Other columns pass through untouched, whatever their names, as they
    travel in one struct; columns named n_lines, n_dropped or n_near are replaced.
    """
    gone = dropped_lines(docs.select("doc_id", "text"), few).distinct()
    gone = gone.groupBy("doc_id", "text_key").agg(F.collect_list("line_no").alias("gone"), F.sum(F.col("near").cast("int")).alias("near"))
    # A column of its own for the split, as a lambda would split again for each line.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    kept = rows.join(gone, rows["id"].eqNullSafe(gone["doc_id"]) & (rows["key"] == gone["text_key"]), "left").withColumn("split", F.split(F.col("row.text"), "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("split") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("split"), i)), "\n"))
    n_lines = F.size(F.filter("split", lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    # In two steps, so that no column of the rows is seen beside the working ones.
    done = kept.select(
        "row", text.alias("text"), F.when(F.col("row.text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
    )
    made = ["text", "n_lines", "n_dropped", "n_near"]
    return done.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in made], *made)
