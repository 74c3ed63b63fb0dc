"""Secrets in texts: fixed patterns, and strings that character Markov models take for random.

Patterns, leftmost and non-overlapping for each kind, failing matches dropped: ``assign`` (a name such as token, then
``:`` or ``=``, then a value of 12 characters or more), ``access`` (AKIA and capitals or digits, 18 characters or more) and
``hex`` (16 or more of 0-9 and a-f). All of these spans are in the result.

The model adds spans of kind ``random``: maximal runs of letters, digits and ``+ / _ = -`` (ASCII) that touch
no other span. First-order Markov chains give the probability of the characters, the first one included.

- Ordinary: two chains trained on all such runs of the corpus that touch no span of a pattern, of which the likelier counts. One goes from
  character to character. The other goes from class to class (lower case, upper case, digits, signs), all characters of a class having
  equal chances, and with SWITCH leaves it open which class is next; so words and names of spellings that the corpus lacks aren't taken for random,
  as long as they don't change classes all the time.
- Random: trained on what the patterns found (values, keys, hexadecimal digits), one chain for each
  set of classes that a string has. The likelier of that chain and of equal chances for all characters of these classes
  counts, so a set without samples, or with samples of another alphabet, has a model too.

A run of at least LEAST characters is a span if the log-likelihood ratio is at least ln(runs) + MARGIN, runs being
how many runs of that length the corpus has. A ratio exceeds t by chance in at most exp(-t) of what the ordinary
chain makes, so exp(-MARGIN) spans are expected by chance in the whole corpus, of whatever size.

Counts are sums over all documents; they are 16 x 68 x 67 numbers at most, and the model is broadcast.
Null texts are empty. Repeated rows and equal texts get equal spans; a text of any length is scanned whole, and
a task holds a slice of 4 MB of text, or one text. An empty table gives a model without counts, and no rows. Columns that
aren't kept are ignored.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import counts_by, over_texts, slices, split_words, text_bytes
from corpusloom.session import table

KINDS = ("assign", "access", "hex", "random")
#: The patterns of the contract, and the beginnings that the first one can have.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
#: Shortest run that the model judges.
LEAST = 12
#: ln of how much rarer than once in the corpus a span by chance shall be.
MARGIN = float(np.log(1000))
#: Share of the equal chances in the random chains.
EVEN = 0.5
#: Share of equal chances for the next class in the ordinary chain of classes, and runs of equal chances that it begins with.
SWITCH, BEGUN = 0.08, 100

SIGNS = b"+/_=-"
#: Number of each byte that a run may have (1 to 67), else 0; 0 also stands for the beginning.
SYMBOL = np.zeros(256, np.int64)
#: Class of each symbol, as a bit: lower case, upper case, digit, sign.
CLASS = np.zeros(68, np.int64)
for _k, (_c, _bit) in enumerate([(c, 1) for c in range(97, 123)] + [(c, 2) for c in range(65, 91)] + [(c, 4) for c in range(48, 58)] + [(c, 8) for c in SIGNS], 1):
    SYMBOL[_c], CLASS[_k] = _k, _bit
SYMBOLS = len(CLASS)
_HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))


def _anchored(pattern: re.Pattern, blob: bytes, starts: np.ndarray, at: np.ndarray):
    """Leftmost non-overlapping matches, given all places where one may start: (text, match)."""
    owner = np.searchsorted(at, starts, "right") - 1
    free = 0
    for start, text, end in zip(starts.tolist(), owner.tolist(), at[owner + 1].tolist()):
        if start >= free and (m := pattern.match(blob, start, end)):
            free = m.end()
            yield text, m


def _found(blob: bytes, word: bytes) -> list[int]:
    out, k = [], blob.find(word)
    while k >= 0:
        out.append(k)
        k = blob.find(word, k + 1)
    return out


def pattern_spans(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of (text, begin, end, kind, begin of the value, end of it) in bytes, in order of begin and kind."""
    blob = data.tobytes()
    rows = []
    lower = blob.lower()
    starts = np.array(sorted(k for name in NAMES for k in _found(lower, name)), np.int64)
    rows += [(text, m.start(), m.end(), 0, m.start(2), m.end(2)) for text, m in _anchored(ASSIGN, blob, starts, at) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    for text, m in _anchored(ACCESS, blob, np.array(_found(blob, b"AKIA"), np.int64), at):
        if m.end() - m.start() >= ACCESS_LEAST:
            rows.append((text, m.start(), m.end(), 1, m.start(), m.end()))
    begin, end, _ = split_words(_HEX[data], at)
    long = end - begin >= HEX_LEAST
    begin, end = begin[long], end[long]
    kind = np.full(len(begin), 2)
    digits = np.stack((np.searchsorted(at, begin, "right") - 1, begin, end, kind, begin, end), 1)
    out = np.concatenate((np.array(rows, np.int64).reshape(-1, 6), digits))
    return out[np.lexsort((out[:, 3], out[:, 1]))]


def _outside(begin: np.ndarray, end: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which ranges touch none of the spans."""
    starts = spans[:, 1]
    ends = np.maximum.accumulate(spans[:, 2]) if len(spans) else starts
    before = np.searchsorted(starts, end, "left")  # spans that begin before the range's end
    return (before == 0) | (np.concatenate(([0], ends))[before] <= begin)


def _chains(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the characters in the ranges that have a symbol: range, previous symbol (0 for the first), symbol; and each range's classes."""
    size = end - begin
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    symbol = SYMBOL[data[np.repeat(begin - first, size) + np.arange(int(size.sum()))]]
    previous = np.concatenate(([0], symbol[:-1])) if len(symbol) else symbol
    previous[first[size > 0]] = 0
    classes = np.zeros(len(size), np.int64)
    for bit in (1, 2, 4, 8):
        classes |= np.where(np.bincount(owner, CLASS[symbol] == bit, len(size)) > 0, bit, 0)
    real = symbol > 0  # a value may have a full stop
    return owner[real], previous[real], symbol[real], classes


def transition_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(chain, previous, symbol, n): chain 0 is the ordinary one, the others are numbered by their classes.

    Two rows count runs and not transitions: (-1, 0, 0) all runs of at least LEAST characters, outside patterns.
    """

    def count(batches):
        total = np.zeros(16 * SYMBOLS * SYMBOLS, np.int64)
        runs = 0
        for part in slices(batches, text):
            data, at = text_bytes(part.column(text))
            spans = pattern_spans(data, at)
            owner, previous, symbol, classes = _chains(data, spans[:, 4], spans[:, 5])
            total += np.bincount((classes[owner] * SYMBOLS + previous) * SYMBOLS + symbol, minlength=len(total))
            begin, end, _ = split_words(SYMBOL[data] > 0, at)
            plain = _outside(begin, end, spans)
            begin, end = begin[plain], end[plain]
            runs += int(np.count_nonzero(end - begin >= LEAST))
            _, previous, symbol, _ = _chains(data, begin, end)
            total += np.bincount(previous * SYMBOLS + symbol, minlength=len(total))
        some = np.flatnonzero(total)
        chain, rest = np.divmod(some, SYMBOLS * SYMBOLS)
        previous, symbol = np.divmod(rest, SYMBOLS)
        columns = [np.append(x, y) for x, y in ((chain, -1), (previous, 0), (symbol, 0), (total[some], runs))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["chain", "previous", "symbol", "n"])

    rows = docs.select(text).mapInArrow(count, "chain bigint, previous bigint, symbol bigint, n bigint")
    return rows.groupBy("chain", "previous", "symbol").agg(F.sum("n").alias("n"))


class Model:
    """Log-likelihoods of the random chains, by set of classes, and of the two ordinary ones, and the threshold of their ratio."""

    def __init__(self, counts: np.ndarray, runs: int):
        """counts: 16 x 68 x 68 transitions, those of the ordinary chain first."""
        self.plain = np.zeros((2, SYMBOLS, SYMBOLS))
        seen = counts[0, :, 1:].astype(np.float64)
        self.plain[0, :, 1:] = np.log((seen + 1) / (seen.sum(1, keepdims=True) + SYMBOLS - 1))
        member = CLASS == np.array([[0], [1], [2], [4], [8]])  # the beginning is a class of its own
        moves = (member @ counts[0] @ member.T)[:, 1:] + BEGUN / 4
        moves = (1 - SWITCH) * moves / moves.sum(1, keepdims=True) + SWITCH / 4
        self.plain[1, :, 1:] = np.log((member.T @ (moves / member[1:].sum(1)) @ member[1:])[:, 1:])
        self.random = np.zeros((2, 16, SYMBOLS, SYMBOLS))
        for classes in range(1, 16):
            even = (((CLASS & classes) > 0) / ((CLASS & classes) > 0).sum())[1:]
            seen = counts[classes][:, 1:] + even
            with np.errstate(divide="ignore"):
                self.random[0, classes, :, 1:] = np.log(even)
                self.random[1, classes, :, 1:] = np.log(seen / seen.sum(1, keepdims=True))
        self.threshold = float(np.log(max(1, runs))) + MARGIN

    def scores(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of each range of characters; that of signs only is minus infinity."""
        owner, previous, symbol, classes = _chains(data, begin, end)
        random, plain = (
            np.maximum(*(np.bincount(owner, x, len(begin)) for x in chains)) for chains in (self.random[:, classes[owner], previous, symbol], self.plain[:, previous, symbol])
        )
        score = random - plain
        return np.where((classes & 7) > 0, score, -np.inf)


def train(docs: DataFrame, text: str = "text") -> Model:
    """A model from all documents; only its bounded table of counts comes to the driver."""
    counts, runs = np.zeros((16, SYMBOLS, SYMBOLS), np.int64), 0
    for chain, previous, symbol, n in transition_counts(docs, text).collect():
        if chain < 0:
            runs = n
        else:
            counts[chain, previous, symbol] = n
    return Model(counts, runs)


def with_secrets(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and secrets: kind, start and end (code points, end exclusive) and value of every span, in order of start and kind."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def each(part):
            data, at = text_bytes(part.column(text))
            spans = pattern_spans(data, at)
            begin, end, _ = split_words(SYMBOL[data] > 0, at)
            some = np.flatnonzero(end - begin >= LEAST)
            some = some[_outside(begin[some], end[some], spans)]
            some = some[model.scores(data, begin[some], end[some]) >= model.threshold]
            begin, end = begin[some], end[some]
            more = np.stack((np.searchsorted(at, begin, "right") - 1, begin, end, np.full(len(some), 3), begin, end), 1)
            spans = np.concatenate((spans, more))
            spans = spans[np.lexsort((spans[:, 3], spans[:, 1]))]
            point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            zero = point[at[spans[:, 0]]]
            blob = data.tobytes()
            rows = pa.StructArray.from_arrays(
                [
                    pa.array([KINDS[k] for k in spans[:, 3].tolist()], pa.string()), pa.array(point[spans[:, 1]] - zero), pa.array(point[spans[:, 2]] - zero),
                    pa.array([blob[a:b].decode() for a, b in spans[:, 4:6].tolist()], pa.string()),
                ],
                ["kind", "start", "end", "value"],
            )
            return {"secrets": pa.ListArray.from_arrays(pa.array(counts_by(spans[:, 0], part.num_rows), pa.int32()), rows)}

        return each

    return over_texts(docs, keep, "secrets array<struct<kind:string,start:bigint,end:bigint,value:string>>", make, text)


def _written(secrets: Column) -> Column:
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _equals(kind: str, x: Column) -> Column:
    return x == kind


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secrets(docs, train(docs), ["doc_id"])
    kinds = F.col("secrets.kind")
    counts = [F.size(F.filter(kinds, partial(_equals, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]]
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("secrets")).alias("spans"))
