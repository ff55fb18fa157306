"""Media columns: a payload as an MPEG transport stream (ISO 13818-1), and back.

``mux`` writes program tables (PAT, PMT), then one private packetised elementary stream: a unit of up
to UNIT payload bytes a PES packet, with a presentation timestamp; every KEY-th unit starts a random
access point, before which the tables are repeated. ``demux`` parses the tables to find the stream,
checks every continuity counter, reassembles the elementary packets, and gives the payload with each
unit's timestamp, place, length and whether it is a random access point.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

UNIT = 32_768
KEY = 8
TICKS = 3_600
PMT_PID, DATA_PID, PROGRAM = 0x100, 0x101, 1
BLOCK = 64

_CRC = []
for _i in range(256):
    _c = _i << 24
    for _ in range(8):
        _c = (_c << 1 ^ (0x04C11DB7 if _c & 0x80000000 else 0)) & 0xFFFFFFFF
    _CRC.append(_c)


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def _table_payload(section: bytes) -> bytes:
    return (b"\x00" + section).ljust(184, b"\xff")


_PAT = _table_payload(_section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big")))
_PMT = _table_payload(_section(2, PROGRAM, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + b"\x06" + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00"))


def _pts(ticks: int) -> bytes:
    ticks &= (1 << 33) - 1
    return bytes([0x21 | ticks >> 29 & 0x0E, ticks >> 22 & 0xFF, ticks >> 14 & 0xFE | 1, ticks >> 7 & 0xFF, ticks << 1 & 0xFE | 1])


def pad(text: str | None) -> bytes:
    """A text's UTF-8 with bytes 0 up to a positive multiple of 64."""
    data = (text or "").encode("utf-8")
    return data.ljust(max(BLOCK, -(-len(data) // BLOCK) * BLOCK), b"\x00")


def mux(payload: bytes, unit: int = UNIT, key: int = KEY, ticks: int = TICKS) -> bytes:
    plain = [bytes([0x47, DATA_PID >> 8, DATA_PID & 0xFF, 0x10 | cc]) for cc in range(16)]
    out: list[bytes] = []
    cc = 0
    tables = 0
    for k, at in enumerate(range(0, len(payload), unit)):
        piece = payload[at : at + unit]
        packet = b"\x00\x00\x01\xbd" + (len(piece) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + _pts(k * ticks) + piece
        entry = k % key == 0
        if entry:
            out += [bytes([0x47, 0x40, 0x00, 0x10 | tables & 15]), _PAT, bytes([0x47, 0x40 | PMT_PID >> 8, PMT_PID & 0xFF, 0x10 | tables & 15]), _PMT]
            tables += 1
        pos = 0
        while pos < len(packet):
            first = pos == 0
            field = b"\x01\x40" if first and entry else b""
            room = 184 - len(field)
            n = min(room, len(packet) - pos)
            if n < room or field:
                length = 183 - n
                field = bytes([length]) + (bytes([0x40 if first and entry else 0]) + b"\xff" * (length - 1) if length else b"")
                head = bytes([0x47, (0x40 if first else 0) | DATA_PID >> 8, DATA_PID & 0xFF, 0x30 | cc])
            elif first:
                head = bytes([0x47, 0x40 | DATA_PID >> 8, DATA_PID & 0xFF, 0x10 | cc])
            else:
                head = plain[cc]
            out += [head, field, packet[pos : pos + n]]
            pos += n
            cc = cc + 1 & 15
    return b"".join(out)


class Broken(ValueError):
    """A stream that doesn't follow the format."""


def _sections(packets: list[bytes]) -> bytes:
    data = packets[0][1 + packets[0][0] :] + b"".join(packets[1:])
    section = data[: 3 + (int.from_bytes(data[1:3], "big") & 0xFFF)]
    if crc32_mpeg(section):
        raise Broken("a table's checksum is wrong")
    return section


def demux(media: bytes) -> dict:
    """payload, units [(pts, offset, length, random access)], packets, gaps (continuity counters that don't follow)."""
    if len(media) % 188:
        raise Broken("not a whole number of packets")
    pmt = stream = -1
    counters: dict[int, tuple[int, int, bool]] = {}
    gaps = 0
    pieces: list[list[bytes]] = []
    entries: list[bool] = []
    for at in range(0, len(media), 188):
        sync, b1, b2, b3 = media[at : at + 4]
        if sync != 0x47:
            raise Broken("a packet doesn't begin with 0x47")
        pid = (b1 & 0x1F) << 8 | b2
        start, body, entry = b1 & 0x40, at + 4, False
        if not b3 & 0x10:
            continue  # no payload: the counter stands still
        if (known := counters.get(pid)) is not None:
            before, packet, repeated = known
            if b3 & 15 == before and not repeated and media[at : at + 188] == media[packet : packet + 188]:
                counters[pid] = before, packet, True  # a packet may be sent twice; the second says nothing new
                continue
            gaps += b3 & 15 != before + 1 & 15
        counters[pid] = b3 & 15, at, False
        if b3 & 0x20:
            length = media[body]
            entry = bool(length and media[body + 1] & 0x40)
            body += 1 + length
        if pid == stream:
            if start:
                pieces.append([])
                entries.append(entry)
            if not pieces:
                raise Broken("an elementary packet without its start")
            pieces[-1].append(media[body : at + 188])
        elif pid == 0 and start:
            section = _sections([media[body : at + 188]])
            pmt = next((int.from_bytes(section[i + 2 : i + 4], "big") & 0x1FFF for i in range(8, len(section) - 4, 4) if section[i : i + 2] != b"\0\0"), -1)
        elif pid == pmt and start:
            section = _sections([media[body : at + 188]])
            i = 12 + (int.from_bytes(section[10:12], "big") & 0xFFF)
            if i < len(section) - 4:
                stream = int.from_bytes(section[i + 1 : i + 3], "big") & 0x1FFF
    payload: list[bytes] = []
    units, offset = [], 0
    for parts, entry in zip(pieces, entries, strict=True):
        packet = b"".join(parts)
        if packet[:3] != b"\0\0\1" or int.from_bytes(packet[4:6], "big") != len(packet) - 6:
            raise Broken("an elementary packet is cut or has no start code")
        pts = None
        if packet[7] & 0x80:
            p = packet[9:14]
            pts = (p[0] >> 1 & 7) << 30 | p[1] << 22 | p[2] >> 1 << 15 | p[3] << 7 | p[4] >> 1
        data = packet[9 + packet[8] :]
        payload.append(data)
        units.append((pts, offset, len(data), entry))
        offset += len(data)
    return {"payload": b"".join(payload), "units": units, "packets": len(media) // 188, "gaps": gaps}


def to_media(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``n_bytes`` and ``media`` in place of the text.

    Nulls: a null text counts as empty, and is stored as 64 zero bytes; other columns stay as they
    are. Equal texts give equal media; repeated rows repeat; an empty table gives no rows; columns
    named n_bytes or media are replaced. Texts are stored whole, one Arrow batch at a time.
    """
    small_batches(df.sparkSession)
    df = df.select(*[c for c in df.columns if c not in ("n_bytes", "media")])
    rest = [f for f in df.schema if f.name != text]
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in rest] + [pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([mux(pad(t)) for t in texts], pa.binary())], names=[f.name for f in rest] + ["n_bytes", "media"])

    return df.mapInArrow(run, f"{kinds}n_bytes long, media binary")


PARSED = "payload binary, units array<struct<pts: long, offset: long, length: long, random_access: boolean>>, packets long, gaps long, error string"


def from_media(df: DataFrame, media: str = "media") -> DataFrame:
    """The rows with what the stored stream holds: payload, units, packets, gaps; a broken stream gives nulls and ``error``, null media gives nulls alone."""
    small_batches(df.sparkSession)
    names = ["payload", "units", "packets", "gaps", "error"]
    df = df.select(*[c for c in df.columns if c not in names])
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)
    units = pa.list_(pa.struct([("pts", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("random_access", pa.bool_())]))

    def parsed(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 5
        try:
            x = demux(data)
        except (Broken, IndexError) as e:
            return None, None, None, None, str(e)
        return x["payload"], [dict(zip(("pts", "offset", "length", "random_access"), u, strict=True)) for u in x["units"]], x["packets"], x["gaps"], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parsed(x) for x in batch.column(batch.schema.get_field_index(media)).to_pylist()]
            added = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.binary(), units, pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(list(batch.columns) + added, names=batch.schema.names + names)

    return df.mapInArrow(run, kinds + PARSED)


def digest(df: DataFrame) -> DataFrame:
    """Digest columns of rows that ``from_media`` gave."""
    last = F.element_at("units", -1)
    feature = F.concat_ws(":", F.lit("mpegts"), F.col("packets"), F.col("gaps"), F.size("units"), last["pts"], F.size(F.filter("units", lambda u: u["random_access"])), F.lower(F.hex(F.crc32("payload"))))
    return df.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -BLOCK, BLOCK)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )


