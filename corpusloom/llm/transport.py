"""Media columns: MPEG transport streams (ISO/IEC 13818-1).

mux() stores a payload as elementary packets (PES) with timestamps in 188-byte transport packets,
with program tables ahead of every random-access point. demux() reads such a stream, or one
from elsewhere: it finds the program tables, checks continuity counters, reassembles elementary
packets, and lists timestamps and random-access points. Damage is counted, not fatal.

A null payload counts as empty. A null or empty stream has no programs. Repeated rows give equal
streams. A task holds some copies of a slice of 1 MB of text and its streams, or of one longer text.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import over_texts
from corpusloom.session import stored, table

PACKET, BLOCK = 188, 576
#: Bytes at the end of the payload of which tail_crc32 is the checksum.
TAIL = 32
#: Payload bytes of an access unit, access units from one random-access point to the next.
UNIT_BYTES, GROUP = 16 * BLOCK, 8
#: Ticks of the 90 kHz clock: the first timestamp, from one unit to the next, and from clock reference to presentation.
FIRST_PTS, FRAME, DELAY = 90_000, 3003, 9000
PAT_PID, PMT_PID, STREAM_PID, NULL_PID = 0, 0x100, 0x101, 0x1FFF
PROGRAM, STREAM_TYPE, STREAM_ID = 1, 0x06, 0xBD  # private data in elementary packets
_START = b"\x00\x00\x01"
FAULTS = ("skipped", "damaged", "scrambled", "discontinuities", "repeated")
#: Bytes of texts or streams that a task turns over at once, or one longer.
SLICE = 1 << 20


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        c = n << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = c << 8 & 0xFFFFFFFF ^ _CRC[c >> 24 ^ b]
    return c


def pad(payload: bytes, block: int = BLOCK) -> bytes:
    """payload and bytes 255, up to a positive multiple of block."""
    return payload + b"\xff" * ((-len(payload)) % block or (0 if payload else block))


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


_PAT = _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(2, PROGRAM, (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00")


def _stamp(mark: int, t: int) -> bytes:
    return bytes([mark << 4 | (t >> 30 & 7) << 1 | 1, t >> 22 & 255, (t >> 15 & 127) << 1 | 1, t >> 7 & 255, (t & 127) << 1 | 1])


def _unstamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1


def mux(payload: bytes) -> bytes:
    """The payload as a transport stream of one program with one stream of private data."""
    out, counter = [], {PAT_PID: 0, PMT_PID: 0, STREAM_PID: 0}

    def packet(pid: int, begins: bool, field_: bytes | None, data: bytes) -> None:
        """field_: the adaptation field without its length; it is stuffed to fill the packet."""
        room = PACKET - 4 - len(data)
        if field_ is not None or room:
            field_ = b"" if room == 1 else (field_ or b"\x00")
            field_ = bytes([room - 1]) + field_ + b"\xff" * (room - 1 - len(field_))
        flags = 0x30 if field_ else 0x10
        out.append(bytes([0x47, 0x40 * begins | pid >> 8, pid & 255, flags | counter[pid]]) + (field_ or b"") + data)
        counter[pid] = counter[pid] + 1 & 15

    for k, at in enumerate(range(0, len(payload), UNIT_BYTES)):
        entry = k % GROUP == 0
        if entry:
            for pid, section in ((PAT_PID, _PAT), (PMT_PID, _PMT)):
                packet(pid, True, None, (b"\x00" + section).ljust(PACKET - 4, b"\xff"))
        pts = FIRST_PTS + k * FRAME & (1 << 33) - 1
        body = b"\x84\x80\x05" + _stamp(2, pts) + payload[at : at + UNIT_BYTES]
        pes = _START + bytes([STREAM_ID]) + len(body).to_bytes(2, "big") + body
        clock = (pts - DELAY) % (1 << 33)
        field_ = bytes([0x10 | 0x40 * entry]) + (clock << 15 | 0x3F << 9).to_bytes(6, "big")
        first = PACKET - 4 - 8
        packet(STREAM_PID, True, field_, pes[:first])
        for p in range(first, len(pes), PACKET - 4):
            packet(STREAM_PID, False, None, pes[p : p + PACKET - 4])
    return b"".join(out)


@dataclass
class Stream:
    """What demux() found."""

    packets: int = 0
    skipped: int = 0  # bytes outside packets
    damaged: int = 0  # packets that a transport error marks, and elementary packets or tables that are torn
    scrambled: int = 0
    discontinuities: int = 0  # gaps of a continuity counter that no flag announces
    repeated: int = 0
    programs: dict[int, dict] = field(default_factory=dict)  # number -> pmt_pid, pcr_pid, streams {pid: type}
    units: list[dict] = field(default_factory=list)  # pid, packet, pts, dts, random_access, data


def _tables(pid: int, section: bytes, s: Stream, map_pids: dict[int, int]) -> None:
    if len(section) < 12 or crc32_mpeg(section):
        s.damaged += 1
        return
    number, body = int.from_bytes(section[3:5], "big"), section[8:-4]
    if not section[5] & 1:  # of a time to come
        return
    if section[0] == 0 and pid == PAT_PID:
        for k in range(0, len(body) - 3, 4):
            n, p = int.from_bytes(body[k : k + 2], "big"), int.from_bytes(body[k + 2 : k + 4], "big") & 0x1FFF
            if n:
                map_pids[p] = n
                s.programs.setdefault(n, {"pmt_pid": p, "pcr_pid": NULL_PID, "streams": {}})["pmt_pid"] = p
    elif section[0] == 2 and map_pids.get(pid) == number and len(body) >= 4:
        streams, k = {}, 4 + (int.from_bytes(body[2:4], "big") & 0xFFF)
        while k + 5 <= len(body):
            streams[int.from_bytes(body[k + 1 : k + 3], "big") & 0x1FFF] = body[k]
            k += 5 + (int.from_bytes(body[k + 3 : k + 5], "big") & 0xFFF)
        s.programs[number] |= {"pcr_pid": int.from_bytes(body[:2], "big") & 0x1FFF, "streams": streams}


def _unit(unit: dict, s: Stream) -> None:
    """Parse a whole elementary packet; a torn one is counted and left out."""
    raw = b"".join(unit.pop("parts"))
    size = int.from_bytes(raw[4:6], "big")
    if raw[:3] != _START or len(raw) < 9 or size and len(raw) < 6 + size:
        s.damaged += 1
        return
    raw = raw[: 6 + size] if size else raw
    unit |= {"pts": None, "dts": None}
    if raw[3] in (0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF):  # without the optional header
        unit["data"] = raw[6:]
    else:
        head, flags = raw[9 : 9 + raw[8]], raw[7]
        if flags & 0x80 and len(head) >= 5:
            unit["pts"] = _unstamp(head)
        if flags & 0xC0 == 0xC0 and len(head) >= 10:
            unit["dts"] = _unstamp(head[5:])
        unit["data"] = raw[9 + raw[8] :]
    s.units.append(unit)


def demux(data: bytes) -> Stream:
    """Parse a transport stream; elementary packets are in the order of their beginnings."""
    s, map_pids = Stream(), {}
    last: dict[int, tuple[int, bytes]] = {}
    sections: dict[int, bytes] = {}
    open_: dict[int, dict] = {}
    at = 0
    while at + PACKET <= len(data):
        if data[at] != 0x47:  # find the next place with a packet after it
            nxt = data.find(b"\x47", at + 1)
            while nxt >= 0 and nxt + PACKET < len(data) and data[nxt + PACKET] != 0x47:
                nxt = data.find(b"\x47", nxt + 1)
            if nxt < 0:
                break
            s.skipped += nxt - at
            at = nxt
            continue
        p = data[at : at + PACKET]
        at += PACKET
        number, s.packets = s.packets, s.packets + 1
        pid, begins, has, counter = (p[1] & 0x1F) << 8 | p[2], p[1] & 0x40, p[3] >> 4 & 3, p[3] & 15
        if p[1] & 0x80:
            s.damaged += 1
            continue
        if pid == NULL_PID:
            continue
        begin, entry, announced = 4, False, False
        if has & 2:
            begin = 5 + p[4]
            if p[4]:
                entry, announced = bool(p[5] & 0x40), bool(p[5] & 0x80)
        if p[3] >> 6:
            s.scrambled += 1
            continue
        if not has & 1 or begin > PACKET:
            continue
        body = p[begin:]
        if pid in last and not announced:
            before, old = last[pid]
            if counter == before and old == body:
                s.repeated += 1
                continue
            if counter != before + 1 & 15:
                s.discontinuities += 1
                sections.pop(pid, None)
                if open_.pop(pid, None):
                    s.damaged += 1
        last[pid] = counter, body
        if pid == PAT_PID or pid in map_pids:
            if begins:
                pointer = body[0]
                if pid in sections:
                    sections[pid] += body[1 : 1 + pointer]
                    _flush(pid, sections, s, map_pids)
                sections[pid] = body[1 + pointer :]
            elif pid in sections:
                sections[pid] += body
            _flush(pid, sections, s, map_pids)
        elif any(pid in g["streams"] for g in s.programs.values()):
            if begins:
                if pid in open_:
                    _unit(open_.pop(pid), s)
                open_[pid] = {"pid": pid, "packet": number, "random_access": entry, "parts": [body]}
            elif pid in open_:
                open_[pid]["parts"].append(body)
    s.skipped += len(data) - at
    for unit in open_.values():
        _unit(unit, s)
    s.units.sort(key=lambda u: u["packet"])
    return s


def _flush(pid: int, sections: dict[int, bytes], s: Stream, map_pids: dict[int, int]) -> None:
    """Take the whole sections off the front of what has been gathered for a PID."""
    while pid in sections:
        got = sections[pid]
        if not got or got[0] == 0xFF:
            del sections[pid]
            return
        size = 3 + (int.from_bytes(got[1:3], "big") & 0xFFF) if len(got) >= 3 else 1 << 16
        if len(got) < size:
            return
        _tables(pid, got[:size], s, map_pids)
        sections[pid] = got[size:]


def payload_of(s: Stream) -> bytes:
    return b"".join(u["data"] for u in s.units)


def feature(s: Stream, payload: bytes) -> str:
    """Counts, the span of timestamps, random-access points, and moments of the samples."""
    x = np.frombuffer(payload, np.uint8)
    stamps = [u["pts"] for u in s.units if u["pts"] is not None]
    entries = ",".join(f"{u['pts']}@{u['packet']}" for u in s.units if u["random_access"])
    moments = f"{x.mean():.6f}/{x.std():.6f}" if len(x) else "-"
    return f"programs={len(s.programs)};packets={s.packets};units={len(s.units)};gaps={s.discontinuities};pts={min(stamps, default='-')}..{max(stamps, default='-')};entries={hashlib.sha256(entries.encode()).hexdigest()[:16]};samples={moments}"


def to_media(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, n_bytes of the text's UTF-8, and media: its padded bytes as a transport stream."""

    def make():
        def each(part):
            raw = [(t or "").encode() for t in part.column(text).to_pylist()]
            return {"n_bytes": pa.array([len(b) for b in raw], pa.int64()), "media": pa.array([mux(pad(b)) for b in raw], pa.binary())}

        return each

    return over_texts(docs, keep, "n_bytes bigint, media binary", make, text, SLICE)


_STAMP = pa.struct([("pid", pa.int32()), ("packet", pa.int64()), ("pts", pa.int64()), ("dts", pa.int64()), ("random_access", pa.bool_())])
_PROGRAM = pa.struct([("number", pa.int32()), ("pmt_pid", pa.int32()), ("pcr_pid", pa.int32()), ("streams", pa.list_(pa.struct([("pid", pa.int32()), ("type", pa.int32())])))])


def _programs(s: Stream) -> list[dict]:
    return [{"number": n, "pmt_pid": g["pmt_pid"], "pcr_pid": g["pcr_pid"], "streams": [{"pid": p, "type": t} for p, t in g["streams"].items()]} for n, g in s.programs.items()]


#: Result columns: DDL type, Arrow type, and the value from the stored bytes, what demux() found, and the payload.
RESULTS = {
    "payload": ("binary", pa.binary(), lambda raw, s, payload: payload),
    "feature": ("string", pa.string(), lambda raw, s, payload: feature(s, payload)),
    "programs": ("array<struct<number:int,pmt_pid:int,pcr_pid:int,streams:array<struct<pid:int,type:int>>>>", pa.list_(_PROGRAM), lambda raw, s, payload: _programs(s)),
    "stamps": ("array<struct<pid:int,packet:bigint,pts:bigint,dts:bigint,random_access:boolean>>", pa.list_(_STAMP), lambda raw, s, payload: [{k: u[k] for k in _STAMP.names} for u in s.units]),
    "faults": ("struct<skipped:bigint,damaged:bigint,scrambled:bigint,discontinuities:bigint,repeated:bigint>", pa.struct([(k, pa.int64()) for k in FAULTS]), lambda raw, s, payload: {k: getattr(s, k) for k in FAULTS}),
    "media_bytes": ("bigint", pa.int64(), lambda raw, s, payload: len(raw)),
    "media_sha256": ("string", pa.string(), lambda raw, s, payload: hashlib.sha256(raw).hexdigest()),
    "payload_sha256": ("string", pa.string(), lambda raw, s, payload: hashlib.sha256(payload).hexdigest()),
    "tail_crc32": ("bigint", pa.int64(), lambda raw, s, payload: zlib.crc32(payload[-TAIL:])),
    "payload_bytes": ("bigint", pa.int64(), lambda raw, s, payload: len(payload)),
}


def read_media(media: DataFrame, keep: list[str], column: str = "media", results: tuple[str, ...] = tuple(RESULTS)) -> DataFrame:
    """The kept columns and, of RESULTS, what is asked for: payload, programs, timestamps, faults, digests.

    stamps has pts, dts, first packet and random-access mark of each elementary packet. Streams are
    parsed one at a time; columns that aren't asked for are never made, so payloads stay in the
    task if only their digests are wanted.
    """

    def make():
        def each(part):
            out: dict[str, list] = {c: [] for c in results}
            for b in part.column(column):
                raw = b.as_py() or b""
                s = demux(raw)
                payload = payload_of(s)
                for c in results:
                    out[c].append(RESULTS[c][2](raw, s, payload))
            return {c: pa.array(v, RESULTS[c][1]) for c, v in out.items()}

        return each

    return over_texts(media, keep, ", ".join(f"{c} {RESULTS[c][0]}" for c in results), make, column, SLICE)


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's stream, stored and read back: digests, program tables, faults, and where timestamps and random-access points are.

    The stream's index (programs, stamps, faults) and its digests are stored as columns of one table; the query
    returns the digests and programs, how many faults there are, and the random-access points.
    """
    media = stored(to_media(table(spark, sf_dir, "documents"), ["doc_id"]), "media")
    index = read_media(media, ["doc_id", "n_bytes"], results=tuple(c for c in RESULTS if c != "payload"))
    index = stored(index, "media-index")
    points = F.transform(F.filter("stamps", lambda u: u["random_access"]), lambda u: F.struct(u["packet"].alias("packet"), u["pts"].alias("pts")))
    faults = sum((F.col(f"faults.{k}") for k in FAULTS[1:]), F.col(f"faults.{FAULTS[0]}"))
    digests = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    return index.select("doc_id", "n_bytes", *digests, "programs", F.size("stamps").cast("bigint").alias("n_stamps"), points.alias("access_points"), faults.alias("n_faults"))
