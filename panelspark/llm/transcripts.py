"""Chat formatting: roles of turns by a hidden Markov model, and canonical rendering.

A transcript is a sequence of blocks. What shows of a block is a speaker marker (``User:``, ``AI:``,
``### Instruction``, ``<|assistant|>`` ..., or none) and features of its lines: length, lines, a
question, its place at the start. The hidden states are the roles. Start, transition and emission
rates are counted from conversations with known roles, with pseudo-counts; markers also carry fixed
prior counts, as training turns seldom have any. Viterbi gives the likeliest roles; each turn is then
rendered as ``<|role|>\\n text \\n<|end|>`` with its marker removed.

Scale: a conversation may hold a third of all turns. It is dealt in chunks of CHUNK turns by turn
number; turns that repeat a number are spread over parts of their own by a hash, in its order. Viterbi
is a product of matrices over (max, +): each chunk gives the best score from each role before it to
each role at its end. Matrices of FAN chunks in a row are multiplied into one, and those again, until
a conversation has at most FAN; roles at the borders are then fixed from the top down, level by level,
so no task sees more than FAN matrices of a conversation. Every chunk is decoded alone between its
borders. A conversation's digest is made of sums over its chunks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

ROLES = ("system", "user", "assistant")
CHUNK = 256
FAN = 256
MAX_TURNS = 200_000

# Speaker markers of transcripts, by role.
MARKERS = {
    "system": ["system", "instructions", "system prompt", "context"],
    "user": ["user", "human", "q", "question", "customer", "prompt", "instruction", "me", "you", "student"],
    "assistant": ["assistant", "ai", "bot", "a", "answer", "agent", "chatgpt", "model", "response", "gpt", "teacher"],
}
_ROLE_OF = {m: r for r, ms in MARKERS.items() for m in ms}
_MARKER = re.compile(r"^\s*(?:<\|(?:im_start\|>)?\s*([a-z]+)(?:\|>)?|\[([a-z ]+)\]\s*:?|#{1,3}\s*([a-z ]+?)\s*:?(?=\n|$)|\**([a-z]+(?: prompt)?)\**\s*[:>])\s*", re.IGNORECASE)


def marker(text: str) -> tuple[str, str]:
    """(role that a leading marker names or "none", the text without it)."""
    m = _MARKER.match(text)
    name = next((g for g in m.groups() if g), "").lower().strip() if m else ""
    role = _ROLE_OF.get(name)
    return (role, text[m.end() :]) if role else ("none", text)


def observed(text: str, first: bool) -> tuple[str, ...]:
    """Marker and line features of a block."""
    role, body = marker(text)
    return (
        f"marker={role}", f"length={min(9, int(math.log2(len(body) + 1)))}", f"lines={min(4, body.count(chr(10)))}",
        f"asks={'?' in body}", f"first={first}", f"code={'```' in body}",
    )


class Hmm:
    """Log rates. ``emit[role][feature]``; unseen features count as their role's floor."""

    def __init__(self, starts: Counter, moves: Counter, seen: Counter):
        total = sum(starts.values())
        self.start = np.array([math.log((starts[r] + 1) / (total + len(ROLES))) for r in ROLES])
        out = {r: sum(moves[r, s] for s in ROLES) for r in ROLES}
        self.move = np.array([[math.log((moves[r, s] + 1) / (out[r] + len(ROLES))) for s in ROLES] for r in ROLES])
        seen = Counter(seen)
        for r in ROLES:
            # Prior counts: a marker names its role 98 times in a hundred where it stands at all.
            for m in ROLES:
                seen[r, f"marker={m}"] += 98 if m == r else 1
            seen[r, "marker=none"] += 100
        kinds: dict[str, set[str]] = {}
        for _, f in seen:
            kinds.setdefault(f.split("=")[0], set()).add(f)
        sums = Counter()
        for (r, f), n in seen.items():
            sums[r, f.split("=")[0]] += n
        self.emit = {f: np.array([math.log((seen[r, f] + 0.5) / (sums[r, k] + 0.5 * (len(fs) + 1))) for r in ROLES]) for k, fs in kinds.items() for f in fs}
        self.floor = {k: np.array([math.log(0.5 / (sums[r, k] + 0.5 * (len(fs) + 1))) for r in ROLES]) for k, fs in kinds.items()}

    def scores(self, texts: list[str], from_start: bool) -> np.ndarray:
        out = np.zeros((len(texts), len(ROLES)))
        for i, t in enumerate(texts):
            for f in observed(t, from_start and i == 0):
                k = f.split("=")[0]
                if k in self.floor:
                    out[i] += self.emit.get(f, self.floor[k])
        return out

    def matrix(self, emitted: np.ndarray, from_start: bool) -> np.ndarray:
        """Best score from each role before the chunk (at a start: any, equal) to each role at its end."""
        m = (np.repeat(self.start[None], len(ROLES), 0) if from_start else self.move) + emitted[0]
        for e in emitted[1:]:
            m = (m[:, :, None] + self.move[None]).max(1) + e
        return m

    def decode(self, emitted: np.ndarray, before: int | None, end: int | None) -> list[int]:
        """Viterbi of a chunk between fixed roles: the one before it (None: it begins the conversation) and its last."""
        score = (self.start if before is None else self.move[before]) + emitted[0]
        back = []
        for e in emitted[1:]:
            step = score[:, None] + self.move
            back.append(step.argmax(0))
            score = step.max(0) + e
        path = [int(score.argmax()) if end is None else end]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def fit(turns: DataFrame, max_turns: int = MAX_TURNS) -> Hmm:
    """Counts from turns (conv_id, turn, role, text) with known roles: conversations taken by a hash of conv_id until about ``max_turns`` turns."""
    n = turns.count()
    share = int(min(1.0, max_turns / max(n, 1)) * 1_000_000)
    small_batches(turns.sparkSession)
    taken = turns.where(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & (F.pmod(F.xxhash64(F.lit(3), F.col("conv_id")), F.lit(1_000_000)) < share)).select("conv_id", "turn", "role", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c: Counter = Counter()
            for turn, role, text in zip(batch.column("turn").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                c.update((role, f) for f in observed(text or "", turn == 0))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c]), pa.array([k[1] for k in c]), pa.array(list(c.values()), pa.int64())], names=["role", "feature", "n"])

    seen = Counter({(r["role"], r["feature"]): r["n"] for r in taken.select("turn", "role", "text").mapInArrow(counted, "role string, feature string, n long").groupBy("role", "feature").agg(F.sum("n").alias("n")).collect()})
    # A turn's successor by an equi-join on the number: no window over a conversation.
    nxt = taken.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("after"))
    moves = Counter({(r["role"], r["after"]): r["n"] for r in taken.select("conv_id", "turn", "role").distinct().join(nxt.distinct(), ["conv_id", "turn"]).groupBy("role", "after").agg(F.count(F.lit(1)).alias("n")).collect()})
    starts = Counter({r["role"]: r["n"] for r in taken.where("turn = 0").groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()})
    return Hmm(starts, moves, seen)


def held_out(conv_id: Column) -> Column:
    """Conversations that nothing is learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(conv_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def rendered(texts: list[str], roles: list[str]) -> str:
    return "\n".join(f"<|{r}|>\n{marker(t)[1].strip()}\n<|end|>" for t, r in zip(texts, roles, strict=True))


def _scan(ms: list[np.ndarray], before: int | None, end: int | None) -> list[int]:
    """Roles at the ends of parts in a row, between a fixed role before them (None: they begin the conversation) and one at their end (None: the best)."""
    score, back = ms[0][0 if before is None else before], []
    for m in ms[1:]:
        step = score[:, None] + m
        back.append(step.argmax(0))
        score = step.max(0)
    ends = [int(score.argmax()) if end is None else end]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    return ends[::-1]


def _borders(ms: DataFrame, kind: str, fan: int = FAN) -> DataFrame:
    """(conv_id, part, m) -> (conv_id, part, before, end): the roles before each part (null: it begins the conversation) and at its end. Parts are numbered with gaps; ``fan`` numbers in a row go into one part of the level above."""
    schema = f"conv_id {kind}, part long, before int, end int"

    def solved(table: pa.Table, before: int | None, end: int | None) -> pa.Table:
        table = table.sort_by("part")
        ends = _scan([np.array(x).reshape(3, 3) for x in table.column("m").to_pylist()], before, end)
        return pa.table({"conv_id": table.column("conv_id"), "part": table.column("part"), "before": pa.array([before, *ends[:-1]], pa.int32()), "end": pa.array(ends, pa.int32())})

    most = ms.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= fan:
        return ms.groupBy("conv_id").applyInArrow(lambda t: solved(t, None, None), schema)
    # Numbers without gaps for this level: ranks within spans of parts, and the parts of spans before. Spans halve until none holds many.
    ms = _renumbered(ms, fan)

    def multiplied(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        m, *rest = [np.array(x).reshape(3, 3) for x in table.column("m").to_pylist()]
        for x in rest:
            m = (m[:, :, None] + x[None]).max(1)
        return pa.table({"conv_id": table.column("conv_id")[:1], "part": table.column("up")[:1], "m": pa.array([m.ravel().tolist()], pa.list_(pa.float64()))})

    above = _borders(cut(ms.groupBy("conv_id", "up").applyInArrow(multiplied, f"conv_id {kind}, part long, m array<double>")), kind, fan)
    above = above.withColumnsRenamed({"conv_id": "_c", "part": "_u", "before": "_before", "end": "_end"})
    inside = ms.join(above, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("up") == F.col("_u"))).select("conv_id", "part", "m", "up", "_before", "_end")
    return inside.groupBy("conv_id", "up").applyInArrow(lambda t: solved(t, t.column("_before")[0].as_py(), t.column("_end")[0].as_py()), schema)


def _renumbered(ms: DataFrame, fan: int) -> DataFrame:
    """The rows with ``place``, their number within the conversation, and ``up``, place // fan. Parts are ranked within spans of part numbers, found by counting, that hold ``fan`` parts at most each; spans before a span are added up by the same means one level above, so no window holds a whole hot conversation."""
    spread = ms.groupBy("conv_id").agg(F.min("part").alias("_lo"), F.max("part").alias("_hi"), F.count(F.lit(1)).alias("_n")).withColumnRenamed("conv_id", "_c")
    j = ms.join(spread, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    # Equal spans of numbers: parts are 2 ** 32 apart but for those of crowded numbers.
    span = F.floor((F.col("part") - F.col("_lo")) / F.greatest(F.lit(1), F.floor((F.col("_hi") - F.col("_lo")) * fan / F.col("_n")))).cast("long")
    j = j.withColumn("_span", span)
    counts = j.groupBy("conv_id", "_span").agg(F.count(F.lit(1)).alias("_k"))
    before = counts.select(F.col("conv_id").alias("_c"), F.col("_span").alias("_s"), (F.sum("_k").over(Window.partitionBy("conv_id").orderBy("_span")) - F.col("_k")).alias("_before"))
    j = j.join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_span") == F.col("_s")))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("conv_id", "_span").orderBy("part")) - 1
    return cut(j.withColumn("place", place).select("conv_id", "part", "m", "place", F.floor(F.col("place") / fan).alias("up")))


def parse_turns(turns: DataFrame, model: Hmm, chunk: int = CHUNK) -> DataFrame:
    """Turns (conv_id, turn, text) -> a row per chunk of a conversation: conv_id, part, turns, roles, text (canonical).

    Nulls: a null text is an empty block; null conv_ids are one conversation; null turn numbers come
    before all others. Equal (conv_id, turn, text) rows count once; turns with one number stand in
    the order of their texts' hashes. A text without lines is an empty block. An empty table gives no rows.
    Other columns, a known role among them, are not looked at.
    """
    if chunk > 256:
        raise ValueError("a chunk has at most 256 turn numbers")
    spark = turns.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    # Where far more rows than a chunk's turns share its numbers, each number is a part, or several by the head of the texts' hashes, in the order of (number, hash).
    number = F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-1))
    rows = rows.withColumns({"number": number, "h": F.xxhash64("text")})
    crowd = rows.groupBy(F.col("conv_id").alias("_c"), F.col("number").alias("_n")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 4 * chunk)
    crowd = crowd.select("_c", "_n", F.least(F.ceil(F.log2(F.col("rows") / chunk)), F.lit(24)).cast("int").alias("bits"))
    rows = rows.join(crowd, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("number") == F.col("_n")), "left")
    slot = F.floor(F.pmod(F.coalesce("turn", F.lit(0)), F.lit(chunk)) * 256 / chunk)
    head = F.floor((F.floor(F.col("h") / (1 << 40)) + (1 << 23)) / F.pow(F.lit(2.0), 24 - F.col("bits")))
    within = F.when(F.col("bits").isNull(), F.lit(0.0)).otherwise(slot * F.pow(F.lit(2.0), F.col("bits")) + head)
    part = (F.col("number") * (1 << 32) + within).cast("long")
    chunks = cut(rows.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("turn", "h", "text"))).alias("turns")))
    spans = chunks.groupBy("conv_id").agg(F.min("part").alias("first_part"), F.count(F.lit(1)).alias("parts")).withColumnRenamed("conv_id", "_c")
    on = F.col("conv_id").eqNullSafe(F.col("_c"))
    placed = chunks.join(spans, on).drop("_c")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = []
            for part, first, block in zip(batch.column("part").to_pylist(), batch.column("first_part").to_pylist(), batch.column("turns").to_pylist(), strict=True):
                start = part == first
                out.append(m.matrix(m.scores([x["text"] for x in block], start), start).ravel().tolist())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(out, pa.list_(pa.float64()))], names=["conv_id", "part", "m"])

    kind = dict(turns.dtypes)["conv_id"]
    several = placed.where("parts > 1")
    borders = _borders(cut(several.mapInArrow(matrices, f"conv_id {kind}, part long, m array<double>")), kind).withColumnsRenamed({"conv_id": "_c", "part": "_p"})
    known = placed.where("parts = 1").select("conv_id", "part", "turns", F.lit(None).cast("int").alias("before"), F.lit(None).cast("int").alias("end")).unionByName(
        several.join(borders, on & (F.col("part") == F.col("_p"))).select("conv_id", "part", "turns", "before", "end")
    )

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            roles, texts, numbers = [], [], []
            for block, before, end in zip(batch.column("turns").to_pylist(), batch.column("before").to_pylist(), batch.column("end").to_pylist(), strict=True):
                ts = [x["text"] for x in block]
                path = [ROLES[k] for k in m.decode(m.scores(ts, before is None), before, end)]
                roles.append(path)
                texts.append(rendered(ts, path))
                numbers.append([x["turn"] for x in block])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(numbers, pa.list_(pa.int64())), pa.array(roles, pa.list_(pa.string())), pa.array(texts)], names=["conv_id", "part", "turns", "roles", "text"])

    return known.mapInArrow(decoded, f"conv_id {kind}, part long, turns array<long>, roles array<string>, text string")


def blocks(transcripts: DataFrame, text: str = "text", key: str = "id") -> DataFrame:
    """Raw transcripts -> turns (conv_id, turn, text): a block begins at a speaker marker or after a blank line."""
    marked = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?im)^(?=\s*(?:<\|[a-z_]+\|>|\[[a-z ]+\]\s*:?|\**(?:user|human|q|question|customer|assistant|ai|bot|a|answer|agent|system|model)\**\s*[:>]))", "\n\n")
    return (
        transcripts.select(F.col(key).alias("conv_id"), F.posexplode(F.split(marked, r"\n[ \t]*\n[\s]*")).alias("turn", "text")).where(F.length(F.btrim("text", F.lit(" \t\r\n"))) > 0)
    )


def digest(parsed: DataFrame) -> DataFrame:
    """A row per conversation: turns, turns of each role, code points of the rendered chunks, and a digest of all chunks with their places, added up so that no conversation meets in one task."""
    of = [(F.size("roles") - F.size(F.array_remove("roles", role))).cast("long").alias(role) for role in ROLES]
    part = parsed.select("conv_id", F.size("roles").cast("long").alias("n"), *of, F.char_length("text").cast("long").alias("chars"), F.xxhash64("part", "text").cast("decimal(38,0)").alias("h"))
    sums = part.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), *[F.sum(r).alias(f"n_{r}") for r in ROLES], F.sum("chars").alias("n_chars"), F.sum("h").alias("h"))
    return sums.select("conv_id", held_out(F.col("conv_id")).alias("held_out"), "n_turns", *[f"n_{r}" for r in ROLES], "n_chars", F.sha2(F.col("h").cast("string"), 256).alias("digest"))
