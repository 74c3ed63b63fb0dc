"""Texts of Arrow batches as numpy arrays: bounded slices, byte buffers, words and code points.

Everything here works on one slice of a batch at a time, so a task's memory is bounded by the
slice limit or by its longest text, whichever is more.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece has at most limit bytes of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < n:
            gone = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, gone + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, end to end, and the n + 1 offsets of the texts; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def code_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts that text_bytes() gave, and their offsets."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begun = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return points, begun[at]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
#: A-Z become a-z; bytes that no word has become 0.
_FOLDED = np.array([c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 0 for c in range(256)], np.uint8)
_VALUES_FOLDED = np.where(_FOLDED > 0, _VALUES[_FOLDED], np.uint64(0))
_STEP = 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = n + 1 + n // 8  # as many as slices need, lest every Python worker hold those of the largest
        for k, b in enumerate((_BASE, _INVERSE)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text: maximal runs of 0-9, a-z, A-Z and non-ASCII characters.

    Returns hash (64 bits, of the word with A-Z lower-cased), text index, and the byte range
    [begin, end) of every word, in order.
    """
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = _FOLDED[data] > 0
    first = np.zeros(n + 1, bool)
    first[at] = True
    before = np.concatenate(([False], inside[:-1]))
    cut = inside & (first | ~before)
    begin = np.flatnonzero(cut)
    end = np.flatnonzero(before & (first | ~inside))
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES_FOLDED[data] * up[:n], out=total[1:])
    hashed = mix((total[end] - total[begin]) * down[begin])
    owner = np.searchsorted(at, begin, "right") - 1
    return hashed, owner, begin, end


def counts_by(owner: np.ndarray, n: int) -> np.ndarray:
    """The n + 1 offsets of each owner's run in a sorted owner array."""
    return np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int64)


def shingles(hashed: np.ndarray, owner: np.ndarray, n_texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of width consecutive words of a text, and their text index.

    A text of fewer words, but not none, has one shingle: all of its words.
    """
    at = counts_by(owner, n_texts)
    size = np.diff(at)
    n = len(hashed)
    q = np.zeros(n, np.uint64)
    for j in range(min(width, n)):
        q[: n - j] += hashed[j:] * np.uint64(pow(_STEP, j, 1 << 64))
    full = np.flatnonzero((np.arange(n) + width) <= at[1:][owner]) if n else np.zeros(0, np.int64)
    out, who = mix(q[full]), owner[full]
    short = np.flatnonzero((size > 0) & (size < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k, t in enumerate(short):
            h = np.uint64(size[t])
            with np.errstate(over="ignore"):
                for x in hashed[at[t] : at[t + 1]]:
                    h = h * np.uint64(_STEP) + x
            extra[k] = h
        out, who = np.concatenate((out, mix(extra))), np.concatenate((who, short))
        order = np.argsort(who, kind="stable")
        out, who = out[order], who[order]
    return out, who


def over_texts(df: DataFrame, keep: list[str], added: str, make: Callable[[], Callable], column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """The kept columns of df, and those that added (a DDL schema) names.

    make() runs once per task and returns a function from a slice of a batch to a dict of
    Arrow arrays, one for each added column. The text column is read even if it isn't kept.
    A kept column of the same name as an added one is an error.
    """
    spark_added = T._parse_datatype_string(added)
    if clash := {f.name for f in spark_added} & set(keep):
        raise ValueError(f"columns of the input have names of results: {sorted(clash)}")
    df = df.select(*dict.fromkeys([*keep, column]))
    schema = T.StructType([df.schema[c] for c in keep] + list(spark_added))
    names, types = schema.names, {f.name: to_arrow_type(f.dataType) for f in spark_added}

    def run(batches):
        each = make()
        for part in slices(batches, column, limit):
            made = each(part)
            yield pa.RecordBatch.from_arrays([part.column(c) if c in keep else made[c].cast(types[c]) for c in names], names)
        each = part = made = None
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give what a task has freed back to the system: a Python worker lives on, and counts to its executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def words_of(column: pa.Array):
    """words() of an Arrow column, with the number of texts at the end."""
    data, at = text_bytes(column)
    return *words(data, at), len(column)


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased, and 0 for those that no word of words() has."""
    return _FOLDED[data]


def split_words(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges [begin, end) of each text's maximal runs of bytes that are inside words, and the texts' offsets in them."""
    n = len(inside)
    around = np.zeros(n + 2, bool)
    around[1 : n + 1] = inside
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    begin = np.flatnonzero(around[1:] & (edge | ~around[:-1]))
    end = np.flatnonzero(around[:-1] & (edge | ~around[1:]))
    return begin, end, counts_by(np.searchsorted(at, begin, "right") - 1, len(at) - 1)


def word_dictionary(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.DictionaryArray:
    """The words in the byte ranges as an array with a dictionary, in which each occurs once."""
    size = end - begin
    offsets = np.concatenate(([0], np.cumsum(size)))
    packed = data[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
