"""Token counts by public vocabularies, as Arrow functions that load the encoder once per task."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


#: Makes a function from a text to its number of tokens, once a task.
Load = Callable[[], Callable[[str], int]]
#: Text that is encoded at once.
SLICE_BYTES = 1 << 20


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Pieces of at most SLICE_BYTES of text, or of one text; an empty array is one piece."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, at = np.cumsum(size), 0
    while at < len(texts) or not at:
        gone = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, gone + SLICE_BYTES, "right")))
        yield texts.slice(at, to - at)
        at = to


def _numbers(n: Callable[[str], int], texts: pa.Array) -> pa.Array:
    """Tokens of each text; each distinct one is encoded once, and only one is a Python string at a time."""
    texts = texts.dictionary_encode()
    made = np.fromiter((n(t.as_py()) for t in texts.dictionary), np.int64, len(texts.dictionary))
    return pa.array(made).take(texts.indices).fill_null(0)  # null where the text is


def _counted(load: Load):
    """An Arrow function that counts a slice of a batch at a time."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        n = load()
        for batch in batches:
            yield pa.concat_arrays([_numbers(n, part) for part in _slices(batch)])

    return F.arrow_udf(count, "bigint")


def counters(**loads: Load):
    """An Arrow function that gives a struct of several counts, in one pass and one Python worker a task."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        each = [load() for load in loads.values()]
        for batch in batches:
            found = [[_numbers(n, part) for n in each] for part in _slices(batch)]
            yield pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*found)], list(loads))

    return F.arrow_udf(count, ", ".join(f"{name} bigint" for name in loads))


def ranks_of(path: str, pattern: str | None = None) -> Load:
    """Loads a counter of a byte-level BPE whose ranks are in a .tiktoken file; special tokens count as text."""

    def load():
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        if pattern is None:
            import public_tokenizers

            words = public_tokenizers.PATTERN
        else:
            words = pattern
        encoding = tiktoken.Encoding("file", pat_str=words, mergeable_ranks=ranks, special_tokens={})
        return lambda t: len(encoding.encode_ordinary(t))

    return load


def pieces_of(path: str) -> Load:
    """Loads a counter of a SentencePiece model."""

    def load():
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))

    return load


def ranks_counter(path: str, pattern: str | None = None):
    """Tokens by ranks_of()."""
    return _counted(ranks_of(path, pattern))


def pieces_counter(path: str):
    """Tokens by pieces_of()."""
    return _counted(pieces_of(path))


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
