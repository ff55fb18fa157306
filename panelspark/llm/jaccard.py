"""N-gram Jaccard self-join by grouped prefixes: exact links and components of documents.

A document's set holds its distinct five-word shingles, as 64-bit hashes; words are runs of bytes
other than ASCII white space, A-Z in lower case. Two documents link when
``100 * |intersection| >= percent * |union|``.

Method. All shingles get one order, rarest first, so that linked sets share a shingle early on: for
sizes x <= y the overlap must reach a = ceil(percent (x + y) / (100 + percent)), so the first common
shingle stands at a place of at most x - a in the one and y - a in the other. A set emits only the
places that can be such. Sets with equal emitted shingles and size are one group, which emits once.

1. Count shingles over all documents. Each task counts its own, packs them by the head of the hash
   into buckets and sends four bytes a shingle; bucket tasks add up and name those that occur more
   than ``often`` times. ``often`` rises with the corpus so that the list stays under ``most_often``
   entries, the proven bound of the broadcast.
2. Emit prefixes. Rare shingles go, packed, to bucket tasks; a run of up to SHORT groups gives its
   group pairs after the size and place filter. Longer runs, and shingles known as frequent, become
   rows: in each size class of a shingle the group with the fewest rare shingles is the pivot, found
   by a pre-aggregated minimum, and each group pairs with the best pivot within reach of its size. No
   run is ever collected.
3. Verify. Pairs of groups, and the pairs of a group's own first member with its others, first meet as
   parity bitmaps: each set keeps a bit for every bucket of its hashes that holds an odd number of
   them, two buckets or more a shingle. Bits that differ are a lower bound of the shingles that do, so
   a pair with more of them than linked sets may have is refused without its texts, and no link is
   lost. The rest is checked on the sets themselves, rebuilt from the whole texts.
4. The rest: after contracting what is proven, only shingles of long runs and group pairs of which
   sets still lie in different components are left; those pairs are expanded to members, and all
   members that lie in different components are verified against each other, too.

So every pair that could link is either verified or already in one component, and copies, however
many, cost a pair each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, lean, small_batches
from .components import components

N = 5
PERCENT = 80
SHORT = 16
MOST_OFTEN = 4_000_000
BUCKET = 2_000_000
FEW = 500_000
MOST_WORDS = 100_000
HELD = 1_500_000
MOST_GROUPS = 200_000


class _Words(dict):
    """Hashes of words, remembered up to a bound; a worker forgets them when a task ends."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; with under n words, the whole sequence as one; without words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return _mixed(np.array([_words[b" ".join(words)] + len(words)], dtype=np.uint64))
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out += ids[i : len(words) - n + 1 + i] * _ODD[i]
    return np.unique(_mixed(out))


def needed(x: int, y: int, percent: int = PERCENT) -> int:
    """Least overlap of linked sets of sizes x and y."""
    return -(-percent * (x + y) // (100 + percent))


def parity(h: np.ndarray) -> bytes:
    """The parity bitmap of a set: a power of two of bits, at least two a shingle and 64."""
    bits = max(64, 1 << max(0, 2 * len(h) - 1).bit_length())
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the size of the symmetric difference, from parity bitmaps; the larger is folded to the smaller."""
    u, v = (np.frombuffer(b, np.uint64) for b in ((x, y) if len(x) <= len(y) else (y, x)))
    return int(np.bitwise_count(u ^ np.bitwise_xor.reduce(v.reshape(-1, len(u)), axis=0)).sum())


def set_id(h: np.ndarray) -> int:
    import xxhash

    return int(np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64).view(np.int64)[0])


def _counted(batches: Iterator[pa.RecordBatch], n: int, bits: int) -> Iterator[pa.RecordBatch]:
    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        h, times = np.unique(np.concatenate(parts), return_counts=True)
        bucket, low = (h >> np.uint64(64 - bits)).astype(np.int64), ((h >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rows = {"bucket": [], "once": [], "many": [], "times": []}
        start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # of buckets that have any
        for i, j in zip(start, np.r_[start[1:], len(bucket)], strict=True):
            one = times[i:j] == 1
            for k, v in (("bucket", bucket[i]), ("once", low[i:j][one].tobytes()), ("many", low[i:j][~one].tobytes()), ("times", times[i:j][~one].astype(np.uint32).tobytes())):
                rows[k].append(v)
        return pa.RecordBatch.from_arrays([pa.array(rows["bucket"], pa.int32()), *(pa.array(rows[k], pa.binary()) for k in ("once", "many", "times"))], names=list(rows))

    parts, held = [], 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            parts.append(shingles(text, n))
            held += len(parts[-1])
            if held > HELD:
                yield packed(parts)
                parts, held = [], 0
    if held:
        yield packed(parts)
    _words.clear()


def _frequent(table: pa.Table, often: int) -> pa.Table:
    """Of one bucket: the shingles that occur more than ``often`` times, and how often."""
    join = lambda name: np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint32)
    once, many, times = join("once"), join("many"), join("times")
    h, at = np.unique(np.concatenate([once, many]), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([np.ones(len(once)), times.astype(float)]), minlength=len(h)).astype(np.int64)
    keep = total > often
    return pa.table({"token": (np.int64(table.column("bucket")[0].as_py()) << np.int64(32)) | h[keep].astype(np.int64), "times": total[keep]})


class Order:
    """The corpus-wide order of shingles: rare ones by hash, then frequent ones by count and hash."""

    def __init__(self, tokens: np.ndarray, times: np.ndarray, bits: int, percent: int = PERCENT):
        self.tokens, self.times, self.bits, self.percent = tokens, times, bits, percent

    def prefix(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens at the places where a first common shingle can stand, in order, their counts (0: rare), and how many of the whole set are rare."""
        token = (h >> np.uint64(32 - self.bits)).astype(np.int64)
        times = np.zeros(len(h), np.int64)
        if len(self.tokens):
            i = np.searchsorted(self.tokens, token)
            i[i == len(self.tokens)] = 0
            times = np.where(self.tokens[i] == token, self.times[i], 0)
        # With the smallest partner the overlap must reach ceil(percent * n / 100).
        p = len(h) - -(-self.percent * len(h) // 100) + 1
        order = np.lexsort((h, times))[:p]
        return token[order], times[order], int((times == 0).sum())


_RUN = np.dtype([("token", "<u4"), ("n", "<i4"), ("pos", "<i4"), ("group", "<i8")])


def _pack(run: np.ndarray) -> bytes:
    """A run by columns, as small numbers then compress on disk and on the way."""
    return b"".join(np.ascontiguousarray(run[k]).tobytes() for k in _RUN.names)


def _unpack(blob: bytes) -> np.ndarray:
    run, at = np.empty(len(blob) // _RUN.itemsize, _RUN), 0
    for k in _RUN.names:
        run[k] = np.frombuffer(blob, _RUN[k], len(run), at)
        at += _RUN[k].itemsize * len(run)
    return run


def _emitted(batches: Iterator[pa.RecordBatch], n: int, order: Order) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, text_key, text): a row for each document; packed places of rare shingles; a row for each place of a frequent one."""
    import xxhash

    names = ["kind", "doc_id", "text_key", "n", "set_id", "grp", "token", "pos", "rare", "blob"]  # blob: the parity bitmap of a document, or packed places
    types = [pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    seen: set[int] = set()
    runs: list[np.ndarray] = []
    buckets: list[np.ndarray] = []

    def rows(columns: dict, size: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in zip(names, types, strict=True)], names=names)

    def flushed() -> pa.RecordBatch:
        run, bucket = np.concatenate(runs), np.concatenate(buckets)
        by = np.argsort(bucket, kind="stable")
        run, bucket = run[by], bucket[by]
        found, start = np.unique(bucket, return_index=True)
        blobs = [_pack(x) for x in np.split(run, start[1:])]
        runs.clear()
        buckets.clear()
        return rows({"kind": [1] * len(found), "token": found, "blob": blobs}, len(found))

    held = 0
    for batch in batches:
        ids, keys, texts = (batch.column(i).to_pylist() for i in range(3))
        docs: dict[str, list] = {k: [] for k in ("kind", "doc_id", "text_key", "n", "set_id", "grp", "blob")}
        often: list[tuple] = []
        for doc_id, key, text in zip(ids, keys, texts, strict=True):
            h = shingles(text, n)
            token, times, unshared = order.prefix(h) if len(h) else (np.empty(0, np.int64), np.empty(0, np.int64), 0)
            sid = set_id(h)
            group = int(np.array([xxhash.xxh3_64_intdigest(token.tobytes(), len(h))], np.uint64).view(np.int64)[0])
            for k, v in (("kind", 0), ("doc_id", doc_id), ("text_key", key), ("n", len(h)), ("set_id", sid), ("grp", group), ("blob", parity(h) if len(h) else None)):
                docs[k].append(v)
            if not len(h) or group in seen:
                continue
            if len(seen) > MOST_GROUPS:
                seen.clear()
            seen.add(group)
            rare = int((times == 0).sum())
            run = np.empty(rare, _RUN)
            run["token"], run["n"], run["pos"], run["group"] = token[:rare] & 0xFFFFFFFF, len(h), np.arange(rare), group
            runs.append(run)
            buckets.append(token[:rare] >> 32)
            held += rare
            often.append((token[rare:], len(h), np.arange(rare, len(token)), group, unshared))
        yield rows(docs, len(ids))
        if size := sum(len(x[0]) for x in often):
            spread = lambda i: np.concatenate([np.full(len(x[0]), x[i]) for x in often])
            yield rows({"kind": np.full(size, 2, np.int8), "token": np.concatenate([x[0] for x in often]), "n": spread(1).astype(np.int32), "pos": np.concatenate([x[2] for x in often]).astype(np.int32), "grp": spread(3), "rare": spread(4).astype(np.int32)}, size)
        if held > HELD:
            yield flushed()
            held = 0
    if held:
        yield flushed()
    _words.clear()


def _paired(table: pa.Table, percent: int) -> pa.Table:
    """Of one bucket of rare shingles: group pairs of short runs (kind 1); the places of longer runs as rows (kind 2)."""
    run = np.unique(np.concatenate([_unpack(x) for x in table.column("blob").to_pylist()]))
    bucket = table.column("token")[0].as_py()
    start = np.flatnonzero(np.r_[True, run["token"][1:] != run["token"][:-1]])
    size = np.diff(np.r_[start, len(run)])
    a, b, long = [], [], []
    for f in np.unique(size[size > 1]):
        at = start[size == f][:, None] + np.arange(f)
        if f > SHORT:
            long.append(at.ravel())
            continue
        x, y = run[at], run[at]
        i, j = np.triu_indices(f, 1)
        x, y = x[:, i].ravel(), y[:, j].ravel()
        swap = x["n"] > y["n"]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        a0 = -(-percent * (x["n"].astype(np.int64) + y["n"]) // (100 + percent))
        fits = (x["n"] - x["pos"] >= a0) & (y["n"] - y["pos"] >= a0)
        a.append(np.minimum(x["group"], y["group"])[fits])
        b.append(np.maximum(x["group"], y["group"])[fits])
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1) if a else np.empty((2, 0), np.int64)
    rest = run[np.concatenate(long)] if long else run[:0]
    k = pairs.shape[1]
    return pa.table({
        "kind": pa.array(np.r_[np.full(k, 1), np.full(len(rest), 2)].astype(np.int8)), "a": pa.array(np.r_[pairs[0], rest["group"]].astype(np.int64)), "b": pa.array(np.r_[pairs[1], np.zeros(len(rest), np.int64)].astype(np.int64)),
        "token": pa.array(np.r_[np.zeros(k, np.int64), (np.int64(bucket) << np.int64(32)) | rest["token"].astype(np.int64)]), "n": pa.array(np.r_[np.zeros(k, np.int32), rest["n"]].astype(np.int32)), "pos": pa.array(np.r_[np.zeros(k, np.int32), rest["pos"]].astype(np.int32)),
    })


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, n_a, n_b, bits_a, bits_b) -> the (a, b) whose bitmaps don't rule out a link."""
    for batch in batches:
        a, b, x, y, u, v = (batch.column(i).to_pylist() for i in range(6))
        keep = [i for i in range(len(a)) if least_difference(u[i], v[i]) <= x[i] + y[i] - 2 * needed(x[i], y[i], percent)]
        yield pa.RecordBatch.from_arrays([pa.array([z[i] for i in keep], pa.int64()) for z in (a, b)], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> the (a, b) that link."""
    last: tuple = (None, None)
    for batch in batches:
        a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
        keep = []
        for i in range(len(a)):
            if last[0] != a[i]:
                last = (a[i], shingles(x[i], n))
            h = shingles(y[i], n)
            both = len(np.intersect1d(last[1], h, assume_unique=True))
            if 100 * both >= percent * (len(last[1]) + len(h) - both):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([pa.array([v[i] for i in keep], pa.int64()) for v in (a, b)], names=["a", "b"])
    _words.clear()


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT, most_often: int = MOST_OFTEN, few: int = FEW) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id (least doc_id reachable by links), root (the component itself, by its least set; null without words) for each row.

    Nulls: a null text has no words; a null doc_id is less than none and names a component only if
    all its ids are null. Empty texts have an empty set and link with nothing. Repeated rows link as
    equal texts do. An empty table gives no rows. Other columns are ignored. Texts are read whole.
    ``often`` (see the module) is max(SHORT, shingles / most_often).
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    size = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    bits = max(5, math.ceil(math.log2(max(1.0, size / BUCKET))))
    often = max(SHORT, math.ceil(size / most_often))

    counted = rows.select("text").mapInArrow(lean(lambda it: _counted(it, n, bits)), "bucket int, once binary, many binary, times binary")
    frequent = counted.groupBy("bucket").applyInArrow(lambda t: _frequent(t, often), "token long, times long").toArrow()
    token, times = frequent.column("token").to_numpy(), frequent.column("times").to_numpy()
    by = np.argsort(token)
    order = spark.sparkContext.broadcast((token[by], times[by]))

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(it, n, Order(*order.value, bits, percent))

    emitted = cut(rows.mapInArrow(lean(emit), "kind byte, doc_id long, text_key long, n int, set_id long, grp long, token long, pos int, rare int, blob binary"))
    placed = emitted.where("kind = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "set_id", "grp", F.col("blob").alias("bits"))
    sets = cut(placed.where("n_shingles > 0").groupBy("set_id", "grp").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_key")).alias("of"), F.min("n_shingles").alias("n"), F.first("bits").alias("bits")))
    paired = cut(emitted.where("kind = 1").select("token", "blob").groupBy("token").applyInArrow(lambda t: _paired(t, percent), "kind byte, a long, b long, token long, n int, pos int"))

    # Long runs: each group pairs with one pivot, the best of the size classes within reach. The best one has the
    # fewest rare shingles: copies of a text have what the text has, and shingles of their own; the text itself
    # lies nearer to all copies than they lie to each other.
    of_group = emitted.where("kind = 2").select("token", "n", "pos", "grp", "rare")
    long = of_group.unionByName(paired.where("kind = 2").select("token", "n", "pos", F.col("a").alias("grp"), F.col("pos").alias("rare"))).groupBy("token", "grp").agg(F.min("n").alias("n"), F.min("pos").alias("pos"), F.min("rare").alias("rare"))
    step = math.log(100 / percent) / 2
    long = long.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / step).cast("int"))
    pivot = F.min(F.struct("rare", "n", "grp", "pos")).alias("p")
    pivots = long.groupBy("token", "class").agg(pivot).select("token", F.explode(F.array(*[F.col("class") + i for i in range(-2, 3)])).alias("class"), "p").groupBy("token", "class").agg(F.min("p").alias("p"))
    a0 = lambda x, y: F.ceil((x + y) * percent / (100 + percent))
    fits = lambda x, px, y, py: (x - px >= a0(x, y)) & (y - py >= a0(x, y))
    starred = long.join(pivots, ["token", "class"]).where(F.col("grp") != F.col("p.grp")).where(fits(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos"))).select(F.least("grp", "p.grp").alias("a"), F.greatest("grp", "p.grp").alias("b"))
    group_pairs = paired.where("kind = 1").select("a", "b").unionByName(starred).distinct()

    # A group's first member stands for it; its others are paired with it.
    member = sets.select("set_id", "grp")
    first = member.groupBy("grp").agg(F.min("set_id").alias("head"), F.max("set_id").alias("tail"))
    heads = first.select("grp", "head")
    inner = member.join(first.where("head != tail"), "grp").where("set_id != head").select(F.col("head").alias("a"), F.col("set_id").alias("b"))
    across = group_pairs.join(heads.select(F.col("grp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("grp").alias("b"), F.col("head").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = _links(rows, sets, inner.unionByName(across), n, percent, few)

    found = components(links)
    # What is left: members of a long run's groups, or of a short run's group pair, in different components.
    of = member.join(found, member["set_id"] == found["node"], "left").select("set_id", "grp", F.coalesce("root", "set_id").alias("root"))
    span = of.groupBy("grp").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"))
    runs = long.join(span, "grp")
    open_ = runs.groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l != h").select("token")
    left = cut(runs.join(open_, "token"))  # a table of its own: the join with itself is then dealt anew, and a shingle that very many groups share can be split
    x, y = left.alias("x"), left.alias("y")
    in_runs = x.join(y, F.col("x.token") == F.col("y.token")).where("x.grp < y.grp and (x.lo != x.hi or y.lo != y.hi or x.lo != y.lo)").where(fits(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))).select(F.col("x.grp").alias("a"), F.col("y.grp").alias("b"))
    split = span.where("lo != hi").select("grp")
    # Heads alone were tried across groups: of two groups not in one component, another member may link.
    ends = [span.select(F.col("grp").alias(g), *(F.col(c).alias(f"{c}_{g}") for c in ("lo", "hi", "members"))) for g in "ab"]
    apart = group_pairs.join(ends[0], "a").join(ends[1], "b").where("(members_a > 1 or members_b > 1) and (lo_a != hi_a or lo_b != hi_b or lo_a != lo_b)").select("a", "b")
    rest_pairs = apart.unionByName(in_runs).unionByName(split.select(F.col("grp").alias("a"), F.col("grp").alias("b"))).distinct()
    wide = rest_pairs.join(of.select(F.col("grp").alias("a"), F.col("set_id").alias("x"), F.col("root").alias("rx")), "a").join(of.select(F.col("grp").alias("b"), F.col("set_id").alias("y"), F.col("root").alias("ry")), "b").where("rx != ry")
    more_pairs = wide.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    tried = inner.unionByName(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _links(rows, sets, more_pairs.join(tried, ["a", "b"], "left_anti"), n, percent, few)
    found = components(cut(links.unionByName(more)))

    rooted = sets.join(found, sets["set_id"] == found["node"], "left").select("set_id", "least", F.coalesce("root", "set_id").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").groupBy("set_id").agg(F.min("component_id").alias("component_id"), F.min("root").alias("root"))
    out = placed.where("n_shingles > 0").join(named, "set_id").select("doc_id", "text_key", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id", "root")
    alone = placed.where("n_shingles = 0").select("doc_id", "text_key", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return out.unionByName(alone)


def _links(rows: DataFrame, sets: DataFrame, pairs: DataFrame, n: int, percent: int, few: int) -> DataFrame:
    """Of pairs (a, b) of sets, those that link: by their bitmaps, then on the texts of a document of each."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()
    u = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    v = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    signed = pairs.join(u, "a").join(v, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    pairs = cut(signed.mapInArrow(lean(lambda it: _near(it, percent)), "a long, b long"))
    of = sets.groupBy("set_id").agg(F.min("of").alias("of")).select("set_id", F.col("of.doc_id").alias("_id"), F.col("of.text_key").alias("_key"))
    wanted = cut(pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct().join(of, "set_id"), 2 * pairs.count())
    ids = F.broadcast(wanted) if wanted.count() <= few else wanted
    texts = cut(rows.join(ids, rows["doc_id"].eqNullSafe(ids["_id"]) & (rows["text_key"] == ids["_key"])).select("set_id", "text"))
    if texts.groupBy("set_id").count().where("count > 1").limit(1).count():  # repeated rows
        texts = cut(texts.dropDuplicates(["set_id"]))
    x, y = texts.select(F.col("set_id").alias("a"), F.col("text").alias("x")), texts.select(F.col("set_id").alias("b"), F.col("text").alias("y"))
    # The lesser end often is a pivot with many partners: its text travels to where the pairs are dealt by the other end.
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return cut(joined.mapInArrow(lean(lambda it: _verified(it, n, percent)), "a long, b long"))


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of each component: its least by (doc_id, text key); rows without words all stay.

    ``found`` is what ``jaccard_components`` gives for these rows. Components go by their root: null or
    repeated ids may name several. Nulls are values like others; of equal rows with one id one stays;
    an empty table gives no rows; other columns, whatever their names, travel in one struct.
    """
    words = found.where("n_shingles > 0")
    one = words.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("one")).select(F.col("one.doc_id").alias("at"), F.col("one.text_key").alias("at_key"))
    empty = found.where("n_shingles = 0").select(F.col("doc_id").alias("at"), F.col("text_key").alias("at_key"))
    kept = one.unionByName(empty.distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    rows = rows.join(kept, rows["id"].eqNullSafe(kept["at"]) & (rows["key"] == kept["at_key"]), "left_semi")
    if words.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count():
        # Equal rows with one id: one of them stays.
        first = Window.partitionBy("id", "key").orderBy(F.lit(1))
        has_words = F.length(F.btrim(F.coalesce("row.text", F.lit("")), F.lit(" \t\r\n\x0b\x0c"))) > 0
        rows = rows.withColumn("place", F.row_number().over(first)).where((F.col("place") == 1) | ~has_words)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
