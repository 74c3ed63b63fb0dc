"""Which texts contain which strings: exact, in one pass per text for few strings, by an equal window for very many.

- Up to AUTOMATON_BYTES of strings become an Aho-Corasick automaton, which every task builds from a broadcast list; a text
  is read once, however many strings there are, and nothing is shuffled.
- Beyond that, each string is known by an anchor: of its windows of the largest power of two of bytes that it has room for (64 at most),
  the one that fewest strings have. A text that contains the string has the anchor too. So anchors meet the windows of
  texts by equality, whatever the lengths; a Bloom filter of the anchors, of at most 32 MB, is broadcast and keeps nearly all other windows from
  the shuffle. Candidates are searched for the whole string in the end, so no collision matters.

Windows are of bytes: UTF-8 strings contain each other as bytes if and only if they do as characters.
Null texts contain nothing. Callers treat empty strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stored

#: Strings of so many bytes are searched for by an automaton, some 50 times as large, in each Python worker.
AUTOMATON_BYTES = 1 << 20
#: The widest window; a power of two.
WIDEST = 64
#: Windows are made of so many bytes of text at once, or of one text.
SLICE_BYTES = 4 << 20
#: Bits of the Bloom filter: this many for each anchor, up to MOST_BITS; it is built in segments, and has PROBES hashes.
BITS_EACH, MOST_BITS, SEGMENT, PROBES = 16, 1 << 28, 1 << 18, 3


def as_list(strings: DataFrame, column: str) -> list[str] | None:
    """The distinct strings that aren't empty, sorted, or None if they have more than AUTOMATON_BYTES."""
    some = strings.select(F.col(column).alias("x")).where("x <> ''").distinct()
    if (some.agg(F.sum(F.octet_length("x"))).first()[0] or 0) > AUTOMATON_BYTES:
        return None
    return sorted(r[0] for r in some.collect())


def contained(text: Column, strings: list[str]) -> Column:
    """array<string>: those of the strings that the text contains, sorted; null for a null text."""
    if not strings:
        return F.when(text.isNotNull(), F.array().cast("array<string>"))

    @F.arrow_udf("array<string>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = ahocorasick.Automaton()
        for s in strings:
            automaton.add_word(s, s)
        automaton.make_automaton()
        for batch in batches:
            found = [None if t is None else sorted({s for _, s in automaton.iter(t)}) for t in (x.as_py() for x in batch)]
            yield pa.array(found, pa.list_(pa.string()))

    return search(text)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_VALUES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), at - at[0]


def _windows(data: np.ndarray, at: np.ndarray, widths: set[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each of the widths, the texts and hashes of all windows; a window of two halves is hashed from theirs."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    left = at[1:][owner] - np.arange(len(data))
    hashed, width = _VALUES[data], 1
    while len(hashed) and width <= max(widths, default=0):
        if width in widths:
            inside = np.flatnonzero(left[: len(hashed)] >= width)
            yield width, owner[inside], hashed[inside] + np.uint64(width)
        hashed = _mix(hashed[:-width] * np.uint64(0xA0761D6478BD642F) + hashed[width:]) if len(hashed) > width else hashed[:0]
        width *= 2


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def _width(size: np.ndarray) -> np.ndarray:
    """The width of the window of a string of so many bytes, at least one."""
    return 1 << np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), int(np.log2(WIDEST)))


def anchors(strings: DataFrame) -> DataFrame:
    """(needle, window, width): of the windows of each needle, the one that fewest needles have."""

    def each(batches):
        for part in _slices(batches, "needle"):
            data, at = _bytes(part.column("needle"))
            mine = _width(np.diff(at))
            for width, owner, hashed in _windows(data, at, set(mine.tolist())):
                keep = mine[owner] == width
                owner, hashed = owner[keep], hashed[keep]
                yield pa.RecordBatch.from_arrays([part.column("needle").take(pa.array(owner)), pa.array(hashed.view(np.int64)), pa.array(np.full(len(owner), width, np.int32))], ["needle", "window", "width"])

    rows = strings.select("needle").mapInArrow(each, "needle string, window bigint, width int").distinct()
    shared = rows.groupBy("window").agg(F.count("*").alias("n"))
    return rows.join(shared, "window").groupBy("needle").agg(F.min_by(F.struct("window", "width"), F.struct("n", "window")).alias("a")).select("needle", "a.window", "a.width")


class Bloom:
    """A set of hashes, with some false members, as bits in a numpy array."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashed: np.ndarray, size: int) -> np.ndarray:
        """PROBES places for each hash, below size (a power of two)."""
        step = _mix(hashed ^ np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
        return np.stack([(hashed + np.uint64(k) * step) & np.uint64(size - 1) for k in range(PROBES)]).astype(np.int64)

    def may_have(self, hashed: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashed), bool)
        for place in self.places(hashed, 8 * len(self.bits)):
            found &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
        return found


def bloom_of(hashes: DataFrame, column: str) -> Bloom:
    """The filter of a column of hashes, built segment by segment in tasks; only its bits come to the driver."""
    size = SEGMENT
    while size < min(MOST_BITS, BITS_EACH * hashes.count()):
        size *= 2

    def places(batches):
        for batch in batches:
            place = np.unique(Bloom.places(batch.column(column).to_numpy().view(np.uint64), size))
            yield pa.RecordBatch.from_arrays([pa.array(place // SEGMENT), pa.array((place % SEGMENT).astype(np.int32))], ["segment", "place"])

    def packed(group: pa.Table) -> pa.Table:
        bits = np.zeros(SEGMENT, bool)
        bits[group.column("place").to_numpy()] = True
        return pa.table({"segment": group.column("segment").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    rows = hashes.select(column).mapInArrow(places, "segment bigint, place int").distinct()
    bits = np.zeros((size // SEGMENT, SEGMENT // 8), np.uint8)
    for segment, made in rows.groupBy("segment").applyInArrow(packed, "segment bigint, bits binary").collect():
        bits[segment] = np.frombuffer(bytes(made), np.uint8)
    return Bloom(bits.reshape(-1))


def candidates(texts: DataFrame, text: str, strings: DataFrame) -> DataFrame:
    """Distinct (text_hash, needle): xxhash64 of the texts, and needles that they may contain; all that they do contain are there.

    strings has needle, distinct and not empty.
    """
    known = stored(anchors(strings), "anchors")
    widths = {r[0] for r in known.select("width").distinct().collect()}
    sent = texts.sparkSession.sparkContext.broadcast(bloom_of(known, "window"))

    def scan(batches):
        bloom = sent.value
        for part in _slices(batches, "text"):
            data, at = _bytes(part.column("text"))
            for _, owner, hashed in _windows(data, at, widths):
                some = bloom.may_have(hashed)
                who, made = owner[some], hashed[some].view(np.int64)
                order = np.lexsort((made, who))
                who, made = who[order], made[order]
                new = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (made[1:] != made[:-1]))) if len(who) else order
                yield pa.RecordBatch.from_arrays([part.column("text_hash").take(pa.array(who[new])), pa.array(made[new])], ["text_hash", "window"])

    seen = texts.select(F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")).mapInArrow(scan, "text_hash bigint, window bigint")
    return seen.join(known.select("needle", "window"), "window").select("text_hash", "needle").distinct()


def occurrences(texts: DataFrame, text: str, strings: DataFrame, needle: str) -> DataFrame:
    """(text, needle) for each text of the table and each distinct needle in it; the empty needle is in all texts but null."""
    needles = strings.select(F.col(needle).alias("needle")).distinct()
    rows = texts.select(F.col(text).alias("text"))
    listed = as_list(needles, "needle")
    if listed is not None:
        found = rows.select("text", F.explode(contained(F.col("text"), listed)).alias("needle"))
    else:
        pairs = stored(candidates(rows, "text", needles.where("needle <> ''")), "candidates")
        found = rows.join(pairs, F.xxhash64("text") == F.col("text_hash")).where(F.contains("text", "needle")).select("text", "needle")
    empty = not needles.where("needle = ''").isEmpty()
    return found.union(rows.where("text IS NOT NULL").select("text", F.lit(""))) if empty else found
