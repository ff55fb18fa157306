"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. Voters. From labelled texts, words and word stems (their first 4 to 7 letters) that mark toxic texts
   far beyond chance become a lexicon, in whatever language they are; near copies are thinned first, so
   that a much copied text doesn't teach its every word. Every entry is a voter, as are patterns
   (insults in English, threats, shouting, runs of marks) and, for the other side, texts without any
   entry and texts with very few for their length. Voters may abstain.
2. Label model. Given the hidden label, votes are independent but for correlated groups: EM estimates
   how often each voter speaks under either label; voters whose votes agree beyond what the label
   explains form groups, whose votes share one voter's weight. ``gold`` says whether the given label is
   one more voter; ``report`` gives what the model finds with and without it.
3. Classifier. Logistic regression on counts of lexicon entries and patterns is fitted to the
   posterior labels. Its score is the probability; lang, source, doc_id and labels are no inputs.

Bounds: the fit uses at most ``max_docs`` labelled texts, chosen by a hash of doc_id, whole texts; all
else follows from those: the lexicon is as long as the false discovery rate lets it be. Only votes and
counts of the sample, and candidate words, reach the driver. Scoring reads each whole text once, without
a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, lean, small_batches

MAX_DOCS = 12_000
MOST_WORDS = 100_000
FALSE_SHARE = 0.3
BLOCK = 512
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.7
GOLD = False
WORD = re.compile(r"[^\W\d_]+")

# English insults and threats, for the pattern voters.
INSULTS = re.compile(r"\b(?:idiots?|morons?|stupid|dumb|losers?|scum|trash|worthless|pathetic|disgusting|clowns?|garbage|imbeciles?|shut up|go to hell|you suck|hate you)\b")
THREATS = re.compile(r"\b(?:kill you|hurt you|beat you|destroy you|you will pay|you deserve to die|i will find you)\b")
SHOUTING = re.compile(r"\b[A-Z]{4,}(?:\s+[A-Z]{4,}){2,}\b")
MARKS = re.compile(r"[!?]{3,}")
PATTERNS = 4


def pattern_counts(text: str, low: str) -> list[int]:
    return [len(INSULTS.findall(low)), len(THREATS.findall(low)), len(SHOUTING.findall(text)), len(MARKS.findall(text))]


def keys_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


def _sketch(words: list[str]) -> tuple[int, int]:
    """Two minimum hashes of a text's word triples: near copies share one of them, most likely."""
    import xxhash

    if len(words) < 3:
        return (xxhash.xxh3_64_intdigest(" ".join(words)) >> 1,) * 2
    triples = {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}
    return min(xxhash.xxh3_64_intdigest(t, 1) for t in triples) >> 1, min(xxhash.xxh3_64_intdigest(t, 2) for t in triples) >> 1


class Model:
    """What scoring needs: lexicon entries with their places, and the classifier's weights."""

    def __init__(self, entries: list[str], weights: np.ndarray, bias: float):
        self.entries, self.weights, self.bias = entries, weights, bias

    def __getstate__(self) -> dict:
        return {"entries": self.entries, "weights": self.weights, "bias": self.bias}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state

    def prepare(self) -> None:
        self.place = {e: i for i, e in enumerate(self.entries)}
        self.of_word: dict[str, tuple[int, ...]] = {}

    def hits(self, words: list[str]) -> Counter:
        if not hasattr(self, "place"):
            self.prepare()
        out: Counter = Counter()
        known = self.of_word
        for word, times in Counter(words).items():
            if (found := known.get(word)) is None:
                if len(known) > MOST_WORDS:
                    known.clear()
                found = known[word] = tuple(self.place[k] for k in keys_of(word) if k in self.place)
            for i in found:
                out[i] += times
        return out

    def score(self, text: str | None) -> float:
        text = text or ""
        low = text.lower()
        z = self.bias
        for i, n in self.hits(WORD.findall(low)).items():
            z += self.weights[i] * (1 + math.log(n))
        for i, n in enumerate(pattern_counts(text, low)):
            if n:
                z += self.weights[len(self.entries) + i] * (1 + math.log(n))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nothing may be learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _sample(docs: DataFrame, labels: DataFrame, max_docs: int) -> DataFrame:
    """(doc_id, toxic, text): labelled rows to learn from, near copies thinned."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).where("toxic = _most").drop("_most")
    n = marked.count()
    share = min(1.0, max_docs / max(n, 1))
    # A hash below a bound rather than a limit: which rows are taken doesn't depend on how they are stored.
    taken = marked.where(F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))).join(taken, "doc_id")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = [_sketch(WORD.findall((t or "").lower())) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=[*batch.schema.names, "_a", "_b"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    known = cut(rows.mapInArrow(lean(sketched), f"{kinds}, _a long, _b long"))
    for c in ("_a", "_b"):
        first = known.groupBy(c).agg(F.min(F.struct("doc_id")).alias("_first"))
        known = known.join(first, c).where(F.struct("doc_id") == F.col("_first")).drop("_first")
    return cut(known.select("doc_id", "toxic", "text").dropDuplicates(["doc_id"]))


def _mined(sample: DataFrame, toxic: int, total: int) -> list[str]:
    """Words and stems that mark toxic texts beyond chance, strongest first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos: Counter = Counter()
            every: Counter = Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                keys = {k for w in set(WORD.findall((text or "").lower())) for k in keys_of(w)}
                every.update(keys)
                if label:
                    pos.update(keys)
            yield pa.RecordBatch.from_arrays([pa.array(list(every)), pa.array(list(every.values()), pa.int64()), pa.array([pos[k] for k in every], pa.int64())], names=["key", "n", "pos"])

    if not toxic or toxic == total:
        return []
    base = toxic / total
    counts = sample.select("text", "toxic").mapInArrow(lean(counted), "key string, n long, pos long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where("pos >= 3")
    p = F.col("pos") / F.col("n")
    gain = F.col("pos") * F.log(p / base) + F.when(F.col("n") > F.col("pos"), (F.col("n") - F.col("pos")) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    # Log-likelihood gain over chance, against the number of candidates tried: false discoveries stay under their share.
    tried = counts.count()
    telling = counts.where(p > min(0.95, 3 * base)).withColumn("gain", gain).where(F.col("gain") >= -math.log(FALSE_SHARE))
    rows = sorted(telling.collect(), key=lambda r: (-r["gain"], r["key"]))  # as many as the sample's vocabulary at most
    last = max((k for k, r in enumerate(rows, 1) if r["gain"] >= math.log(max(tried, 1) / (FALSE_SHARE * k))), default=0)
    return [r["key"] for r in rows[:last]]


def label_model(fired: list[list[int]], sides: np.ndarray, prior: float, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The voters that spoke on each row, and the label that each voter speaks for -> posterior of label 1, and each voter's share of its group's weight."""
    n, v = len(fired), len(sides)
    row = np.array([i for i, f in enumerate(fired) for _ in f], dtype=np.int64)
    col = np.array([j for f in fired for j in f], dtype=np.int64)
    lean = np.bincount(row, np.where(sides == 1, 1.0, -1.0)[col], n)
    q = 1 / (1 + np.exp(-(lean + np.log(prior / (1 - prior)))))
    share = np.ones(v)
    for step in range(rounds):
        spoke = [np.bincount(col, w[row], v) for w in (q, 1 - q)]
        rate = [(s + 0.5) / (w.sum() + 1) for s, w in zip(spoke, (q, 1 - q), strict=True)]
        silent = np.log1p(-rate[0]) - np.log1p(-rate[1])
        weight = np.log(rate[0]) - np.log(rate[1]) - silent
        if step == rounds // 2 and n > 3:
            share = 1 / _group_sizes(row, col, q, spoke, n, v)
        z = np.log(prior / (1 - prior)) + (share * silent).sum() + np.bincount(row, (share * weight)[col], n)
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        prior = float(np.clip(q.mean(), 1e-3, 1 - 1e-3))
    return q, share


def _group_sizes(row: np.ndarray, col: np.ndarray, q: np.ndarray, spoke: list[np.ndarray], n: int, v: int) -> np.ndarray:
    """How many voters, itself included, each voter is correlated with beyond what the label explains: over 0.6 of what is left of their votes. Moments alone, BLOCK voters at a time."""
    s1, s0 = spoke
    m1, m0 = s1 / max(q.sum(), 1e-9), s0 / max((1 - q).sum(), 1e-9)
    q11, q10, q00 = float((q * q).sum()), float((q * (1 - q)).sum()), float(((1 - q) ** 2).sum())

    def left(together: np.ndarray, a: slice, b: slice) -> np.ndarray:
        cross = np.outer(m1[a], s1[b]) + np.outer(m0[a], s0[b]) + np.outer(s1[a], m1[b]) + np.outer(s0[a], m0[b])
        return together - cross + q11 * np.outer(m1[a], m1[b]) + q10 * (np.outer(m1[a], m0[b]) + np.outer(m0[a], m1[b])) + q00 * np.outer(m0[a], m0[b])

    every = slice(0, v)
    own = s1 + s0 - 2 * (m1 * s1 + m0 * s0) + q11 * m1 * m1 + 2 * q10 * m1 * m0 + q00 * m0 * m0
    sd = np.sqrt(np.maximum(own, 0)) + 1e-9
    sizes = np.zeros(v)
    for at in range(0, v, BLOCK):
        b = slice(at, min(v, at + BLOCK))
        votes = np.zeros((n, b.stop - at), np.float32)
        mine = (col >= at) & (col < b.stop)
        votes[row[mine], col[mine] - at] = 1
        together = np.zeros((v, b.stop - at))
        np.add.at(together, col, votes[row])
        sizes[b] = (np.abs(left(together, every, b) / np.outer(sd, sd[b])) > 0.6).sum(0)
    return np.maximum(1, sizes)


def _logistic(rows: list[dict[int, float]], width: int, y: np.ndarray, l2: float = 1.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Sparse logistic regression by accelerated gradient steps."""
    at = np.array([i for i, r in enumerate(rows) for _ in r], dtype=np.int64)
    col = np.array([k for r in rows for k in r], dtype=np.int64)
    val = np.array([x for r in rows for x in r.values()], dtype=float)
    n = len(rows)
    w, b = np.zeros(width), 0.0
    ahead, ahead_b = w.copy(), b
    big = (np.bincount(at, val * val, n).max(initial=0.0) + 1) * n / 4 + l2
    step = 8 / big
    t = 1.0
    for _ in range(rounds):
        z = np.bincount(at, val * ahead[col], n) + ahead_b if len(at) else np.full(n, ahead_b)
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(col, val * e[at], width) + l2 * ahead if len(at) else l2 * ahead
        nw, nb = ahead - step * g, ahead_b - step * e.sum()
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        if (e.sum() * (nb - b) + g @ (nw - w)) > 0:
            ahead, ahead_b, nt = nw, nb, 1.0
        w, b, t = nw, nb, nt
    return w, float(b)


class Sample:
    """What is fitted on: lexicon entries, counts of entries and patterns by row, words by row, given labels."""

    def __init__(self, docs: DataFrame, labels: DataFrame, max_docs: int):
        small_batches(docs.sparkSession)
        sample = _sample(docs, labels, max_docs)
        total, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        self.entries = entries = _mined(sample, toxic, total)
        if not entries:
            return

        def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model(entries, np.zeros(len(entries) + PATTERNS), 0.0)
            for batch in batches:
                out = []
                for text in batch.column("text").to_pylist():
                    text = text or ""
                    low = text.lower()
                    words = WORD.findall(low)
                    f = dict(model.hits(words)) | {len(entries) + i: n for i, n in enumerate(pattern_counts(text, low)) if n}
                    out.append((list(f), list(f.values()), len(words)))
                yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int64()), *(pa.array([x[i] for x in out], pa.list_(pa.int64())) for i in (0, 1)), pa.array([x[2] for x in out], pa.int64())], names=["toxic", "at", "n", "words"])

        got = sample.select("toxic", "text").mapInArrow(lean(featured), "toxic long, at array<long>, n array<long>, words long").toArrow().to_pydict()
        self.rows = [dict(zip(a, x, strict=True)) for a, x in zip(got["at"], got["n"], strict=True)]
        self.gold, self.words = np.array(got["toxic"]), got["words"]

    def posterior(self, gold: bool) -> np.ndarray:
        """The label model's belief in label 1 for each row. Voters: entries and patterns for 1, no sign and few signs for 0; with ``gold`` the given label, for either."""
        width = len(self.entries) + PATTERNS
        sides = np.array([1] * width + [0, 0, 1, 0][: 4 if gold else 2])
        fired = []
        for f, words, label in zip(self.rows, self.words, self.gold, strict=True):
            hits = sum(n for k, n in f.items() if k < len(self.entries))
            fired.append([*f, *([width] if not f else []), *([width + 1] if hits * 2000 < words else []), *([width + 3 - int(label)] if gold else [])])
        return label_model(fired, sides, float(np.clip(self.gold.mean(), 0.01, 0.99)))[0]

    def model(self, gold: bool) -> Model:
        w, b = _logistic([{k: 1 + math.log(n) for k, n in f.items()} for f in self.rows], len(self.entries) + PATTERNS, self.posterior(gold), l2=0.05)
        return Model(self.entries, w, b)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, gold: bool = GOLD) -> Model:
    """A model from the labelled texts. Without usable labels, or with one class only, it holds the English patterns alone."""
    sample = Sample(docs, labels, max_docs)
    return sample.model(gold) if sample.entries else Model([], np.array([4.0, 4.0, 0.5, 0.5]), -4.0)


def report(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> dict[str, dict[str, float]]:
    """With and without the given label as a voter: rows, voters, and of the posterior at a half its precision and recall against the given labels of the sample."""
    sample, out = Sample(docs, labels, max_docs), {}
    for gold in (True, False) if sample.entries else ():
        found = sample.posterior(gold) >= 0.5
        both = float((found & (sample.gold == 1)).sum())
        out["with" if gold else "without"] = {"rows": len(found), "entries": len(sample.entries), "precision": both / max(1.0, float(found.sum())), "recall": both / max(1.0, float((sample.gold == 1).sum()))}
    return out


def score(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A column with the score of each whole text; null counts as empty."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array([m.score(t) for t in texts.to_pylist()], pa.float64())

    return scored(F.col(text))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Nulls: a null text scores as the empty text; a null doc_id or label teaches nothing. A doc_id
    with contradicting labels teaches nothing. Repeated rows get equal scores, ties don't occur, an
    empty table gives no rows, other columns are ignored.
    """
    model = fit(docs, labels)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, model).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
