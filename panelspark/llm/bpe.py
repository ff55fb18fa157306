"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming UTF-8 decoding.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly when each neighbouring pair
is the encoding of the pair's bytes (for vocabularies in which every merged token merges to itself).
That makes BPE a finite-state matter: a hypothesis is (last whole token, place in the vocabulary's
trie); a byte moves each along the trie and, where the trie has a token that may follow the last
one, also forks a hypothesis at the trie's root. A prefix of the input has one encoding, so a set of
hypotheses holds at most one per length of the unfinished token: the lookahead is bounded by the
longest token. Sets are states of a deterministic transducer, built when first met; a state names
the token that ends there, and a token is out once all hypotheses agree on it.

Each match of the split pattern is encoded separately; a memo from match to ids spares most of them
the walk. The walk looks every WAIT bytes for what all hypotheses agree on, so that a match of any
length is encoded in bounded memory. States and memo are dropped when they reach their bounds, which
costs time only.

Decoding. Ids become bytes a block of STEP ids at a time; an incremental machine over UTF-8 holds back
an unfinished code point between blocks, so that each piece it gives has whole code points.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lean, small_batches

MOST_STATES = 120_000
WAIT = 256
STEP = 4_096
NODE = 20  # bits of a trie node within a hypothesis; the last whole token stands above them
MASK = (1 << NODE) - 1
NONE = MASK  # no token yet
MOST_PIECES = 150_000
MOST_PAIRS = 200_000


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Transducer:
    """Compiled merges: ``encode`` maps the bytes of one match to ids."""

    def __init__(self, ranks: bytes):
        pairs = [line.split() for line in ranks.splitlines() if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes_of = {i: t for t, i in self.rank.items()}
        if any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.follows: dict[int, bool] = {}
        # A token's last merge joins the one split whose halves may stand side by side under the merges before it.
        merges = []
        for i in sorted(self.bytes_of):
            t = self.bytes_of[i]
            if len(t) == 1:
                merges.append(i)
                continue
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                if a is not None and b is not None and (a in self.parts or len(t[:k]) == 1) and (b in self.parts or len(t[k:]) == 1) and self._may_follow(a, b):
                    self.parts[i] = a, b
                    self.merged[a, b] = i
                    merges.append(i)
                    break
        self.child: dict[int, int] = {}  # trie node and byte -> node
        self.token = [-1]
        self.depth = [0]
        inner = bytearray(1)
        for i in merges:
            at = 0
            for byte in self.bytes_of[i]:
                inner[at] = 1
                if (to := self.child.get(at << 8 | byte)) is None:
                    to = self.child[at << 8 | byte] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[at] + 1)
                    inner.append(0)
                at = to
            self.token[at] = i
        self.inner = bytes(inner)
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        self.whole: list[int] = []
        self.moves: dict[int, int] = {}
        self._state((NONE << NODE,), -1)

    def forget(self) -> None:
        """Drops all that was learned from texts; what the vocabulary alone gives stays."""
        self.follows.clear()
        self._reset()

    def _state(self, hypotheses: tuple[int, ...], whole: int) -> int:
        if (i := self.ids.get(hypotheses)) is None:
            i = self.ids[hypotheses] = len(self.states)
            self.states.append(hypotheses)
            self.whole.append(whole)
        return i

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart: unmerges the later of the two along the boundary and looks for a merge across it that comes first."""
        bound = len(self.rank) + 1 << 32
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < bound:
                return False
            # Merges happen in order of rank, the left one first at a tie: the later side was two parts until its own merge.
            if a > b and a in self.parts:
                bound, a = a, self.parts[a][1]
            elif b in self.parts:
                bound, b = b + 1, self.parts[b][0]
            elif a in self.parts:
                bound, a = a, self.parts[a][1]
            else:
                return True

    def _move(self, state: int, byte: int) -> int:
        """The state after a byte, made when first asked for."""
        child, tokens, inner, follows = self.child, self.token, self.inner, self.follows
        after = []
        whole = -1
        for hypothesis in self.states[state]:
            at = child.get((hypothesis & MASK) << 8 | byte)
            if at is None:
                continue
            last = hypothesis >> NODE
            if whole < 0 and (t := tokens[at]) >= 0:
                if last == NONE:
                    whole = t
                else:
                    if (may := follows.get(last << NODE | t)) is None:
                        if len(follows) > MOST_PAIRS:
                            follows.clear()
                        may = follows[last << NODE | t] = self._may_follow(last, t)
                    if may:
                        whole = t
            if inner[at]:
                after.append(last << NODE | at)
        # One encoding per prefix: exactly one hypothesis is whole here, and begins its next token.
        after.append(whole << NODE)
        to = self.moves[state << 8 | byte] = self._state(tuple(after), whole)
        return to

    def transduce(self, data: Iterable[int], wait: int = WAIT) -> Iterator[int]:
        """Bytes -> tokens, each once all hypotheses agree on it, which is looked for every ``wait`` bytes: the lookahead is that and the longest token at most."""
        moves, whole, state = self.moves, self.whole, 0
        ends: list[int] = []  # the token that ends at each byte since the last one emitted
        due = wait
        for byte in data:
            to = moves.get(state << 8 | byte)
            if to is None:
                if len(self.states) > MOST_STATES:
                    kept = self.states[state], whole[state]
                    self._reset()
                    moves, whole, state = self.moves, self.whole, self._state(*kept)
                to = self._move(state, byte)
            state = to
            ends.append(whole[state])
            if len(ends) >= due:
                out, sure = self._agreed(state, ends)
                yield from out
                del ends[:sure]
                due = len(ends) + wait
        yield from self._back(ends, len(ends))

    def _back(self, ends: list[int], at: int) -> list[int]:
        """The tokens of the first ``at`` bytes, read off from the end."""
        out = []
        while at:
            out.append(ends[at - 1])
            at -= len(self.bytes_of[out[-1]])
        out.reverse()
        return out

    def _agreed(self, state: int, ends: list[int]) -> tuple[list[int], int]:
        """Tokens that stand in what every hypothesis has behind it, and their bytes. A prefix has one encoding, so that is all up to the last border they share."""
        shared: set[int] | None = None
        for h in self.states[state]:
            at = len(ends) - self.depth[h & MASK]
            borders = {at}
            while at:
                at -= len(self.bytes_of[ends[at - 1]])
                borders.add(at)
            shared = borders if shared is None else shared & borders
        sure = max(shared or {0})
        return self._back(ends, sure), sure

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        if (known := self.rank.get(piece)) is not None:
            return [known]
        return list(self.transduce(piece))


class Utf8Stream:
    """Bytes in any pieces -> pieces of whole code points; an unfinished one waits for its rest. Nothing is lost: ill-formed bytes pass, and read as U+FFFD."""

    def __init__(self) -> None:
        self.held = b""

    def whole(self, data: bytes) -> bytes:
        """What is complete of the bytes so far."""
        data = self.held + data
        # The state after the last byte: how far back a lead byte stands that wants more bytes than there are.
        waiting = 0
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte & 0xC0 != 0x80:
                wants = 1 if byte < 0xC2 or byte > 0xF4 else 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2
                waiting = back if wants > back else 0
                break
        end = len(data) - waiting
        self.held = data[end:]
        return data[:end]

    def feed(self, data: bytes) -> str:
        return self.whole(data).decode("utf-8", "replace")

    def rest(self) -> bytes:
        """Bytes of a code point that never came to its end."""
        rest, self.held = self.held, b""
        return rest

    def close(self) -> str:
        return self.rest().decode("utf-8", "replace")


class Memo(dict):
    """Matches and their packed ids, up to a bound."""

    def __init__(self, fst: Transducer):
        super().__init__()
        self.fst = fst

    def __missing__(self, piece: str) -> bytes:
        if len(self) > MOST_PIECES:
            self.clear()
        ids = self.fst.encode(piece.encode("utf-8", "surrogatepass"))
        self[piece] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class Codec:
    """Whole texts to ids and back, with a bounded memo of matches."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        self.fst = Transducer(ranks)
        # Unicode's White_Space, as in the split pattern's own engine.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")).findall
        self.memo = Memo(self.fst)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.split(text)))

    def forget(self) -> None:
        """Drops the states and the memo: tasks go to idle workers in turn, so each that ever ran one would keep them otherwise. They are soon learned again."""
        self.memo.clear()
        self.fst.forget()


class Vocabulary:
    """What decoding needs: the bytes of each id."""

    def __init__(self, ranks: bytes):
        of = {int(b): base64.b64decode(a) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        self.bytes_of = [of.get(i, b"") for i in range(max(of) + 1)]

    def pieces(self, stream: Iterable[Sequence[int]]) -> Iterator[bytes]:
        """Pieces of a stream of ids -> the bytes they stand for, in pieces of whole code points."""
        machine = Utf8Stream()
        for ids in stream:
            yield machine.whole(b"".join(map(self.bytes_of.__getitem__, ids)))
        yield machine.rest()

    def decode(self, ids: Sequence[int], step: int = STEP) -> bytes:
        return b"".join(self.pieces(ids[i : i + step] for i in range(0, len(ids), step)))

    def decode_text(self, stream: Iterable[Sequence[int]]) -> Iterator[str]:
        """Pieces of a stream of ids -> pieces of text."""
        return (piece.decode("utf-8", "replace") for piece in self.pieces(stream))


_made: dict[tuple, Codec | Vocabulary] = {}


def _of_worker(kind: type, ranks: bytes, *more: str) -> Codec | Vocabulary:
    """One of a kind and vocabulary per worker."""
    key = kind, hashlib.sha256(ranks).hexdigest(), *more
    if key not in _made:
        for other in [k for k in _made if k[0] is kind]:
            del _made[other]
        _made[key] = kind(ranks, *more)
    return _made[key]


def _pass_through(batches: Iterator[pa.RecordBatch], column: str, work) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        i = batch.schema.get_field_index(column)
        rest = [k for k in range(batch.num_columns) if k != i]
        added = work(batch.column(i).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in rest] + list(added.values()), names=[batch.schema.names[k] for k in rest] + list(added))


def unpacked(ids: bytes) -> list[int]:
    """Ids from little-endian unsigned 32-bit integers."""
    import numpy as np

    return np.frombuffer(ids, "<u4").tolist()


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows with ``ids`` (little-endian unsigned 32-bit integers) in place of the text.

    Nulls: a null text counts as empty; other columns, null or not, stay. Empty texts have no ids.
    Texts are read whole, one Arrow batch at a time. Repeated rows repeat. An empty table gives no
    rows. A column named ids is replaced. The rank file is read on the driver and broadcast: its size
    is the vocabulary's, whatever the data.
    """
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    df = df.select(*[c for c in df.columns if c != "ids"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _of_worker(Codec, ranks.value, pattern)
        yield from _pass_through(batches, text, lambda texts: {"ids": pa.array([c.encode(t or "") for t in texts], pa.binary())})
        c.forget()

    return df.mapInArrow(lean(run), f"{kinds}, ids binary")


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """The rows with ``out``, the bytes that the ids stand for.

    Null ids give null, empty ones no bytes; ids outside the vocabulary fail. Other columns stay, null
    or not; a column named as ``out`` is replaced. Repeated rows repeat; an empty table gives no rows.
    """
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    df = df.select(*[c for c in df.columns if c != out])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _of_worker(Vocabulary, ranks.value)

        def work(values: list) -> dict:
            texts = pa.array([None if v is None else c.decode(unpacked(v)) for v in values], pa.binary())
            return ({ids: pa.array(values, pa.binary())} if keep_ids else {}) | {out: texts}

        return _pass_through(batches, ids, work)

    return df.mapInArrow(lean(run), f"{kinds}{f', `{ids}` binary' if keep_ids else ''}, `{out}` binary")


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "decoded") -> DataFrame:
    """The rows with ``ids`` and ``out``, the bytes decoded from them, in place of the text: ``decode`` of ``encode``, in one Python worker a task instead of two.

    Nulls, empty texts, repeated rows and empty tables as in ``encode``; columns named ids or as ``out`` are replaced.
    """
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    df = df.select(*[c for c in df.columns if c not in {"ids", out} - {text}])
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name != text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, v = _of_worker(Codec, ranks.value, pattern), _of_worker(Vocabulary, ranks.value)

        def work(texts: list) -> dict:
            ids = [c.encode(t or "") for t in texts]
            return {"ids": pa.array(ids, pa.binary()), out: pa.array([v.decode(unpacked(i)) for i in ids], pa.binary())}

        yield from _pass_through(batches, text, work)
        c.forget()

    return df.mapInArrow(lean(run), f"{kinds}ids binary, `{out}` binary")
