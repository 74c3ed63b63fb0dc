"""Toxicity: maximum-scoring segments over token log-odds, with extreme-value calibration.

A token's score is its log-odds between toxic and other documents under an informative
Dirichlet prior, if they are significant either way, less a drift that makes the mean negative. Tokens are
words; a word without evidence of its own takes that of its longest known beginning. A linear scan finds all maximal
scoring segments. A segment's score S in a text of n words has the E-value K n exp(-lambda S);
lambda and K come from the scores of non-toxic documents, and the text's best segment, on that
scale, is calibrated to a probability.

A null text counts as empty and gets the lowest probability. Without toxic labels every score is 0.
A task holds some arrays of 8 bytes for each byte of a slice of 4 MB of text, or of one longer text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import _VALUES_FOLDED, _power, counts_by, mix, over_texts, slices, text_bytes, words
from corpusloom.llm.calibration import Isotonic, isotonic, labelled_sample, not_remainder, with_labels
from corpusloom.llm.langid import remainder
from corpusloom.session import stored, table

#: At most about so many labelled documents of each class train the model.
TRAIN_DOCS = 8000
#: Bytes of a word's beginnings that are tokens too, longest first.
BEGINNINGS = (7, 6, 5, 4)
#: Mass of the Dirichlet prior, least z-score (either way) and least documents of a token, negative drift of each word.
PRIOR, LEAST_Z, LEAST_DOCS, DRIFT = 2.0, 3.0, 3, 0.4
#: Least log-odds of a token, either way; it keeps out words that are only likelier in longer documents.
LEAST_ODDS = 1.2
SIGNIFICANT = 0.05
THRESHOLD = 0.3


def tokens(data: np.ndarray, at: np.ndarray):
    """words() and, for each word, the hashes of it and of its BEGINNINGS (0 where it is no longer)."""
    hashed, owner, begin, end = words(data, at)
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES_FOLDED[data] * up[: len(data)], out=total[1:])
    levels = [hashed]
    for k in BEGINNINGS:
        stop = np.minimum(begin + k, end)
        levels.append(np.where(end - begin > k, mix((total[stop] - total[begin]) * down[begin] + np.uint64(k)), np.uint64(0)))
    return owner, begin, end, levels


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [begin, end) of a sequence, in one pass.

    Each candidate keeps the running total left of it and at its end; a new one is joined with
    the last candidate that begins lower and ends no higher, as long as there is one.
    """
    total, kept = 0.0, []  # begin, end, total before, total at the end
    for k, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = (k, k + 1, before, total)
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= new[3]:
                kept.append((*new, j))
                break
            new = (kept[j][0], new[1], kept[j][2], new[3])
            del kept[j:]
    return [(b, e, high - low) for b, e, low, high, _ in kept]


@dataclass
class SegmentModel:
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0  # lambda of the extreme-value distribution
    scale: float = 1.0  # K
    curve: Isotonic | None = None

    def lookup(self, levels: list[np.ndarray]) -> np.ndarray:
        """The score of each word: of itself if known, or else of its longest known beginning."""
        score = np.zeros(len(levels[0]))
        if not len(self.keys):
            return score - DRIFT
        for h in reversed(levels):
            k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            known = self.keys[k] == h
            score[known] = self.odds[k[known]]
        return score - DRIFT

    def passages(self, column: pa.Array) -> list[list[tuple[int, int, float]]]:
        """The maximal segments of each text as (first word, last word + 1, normalised score)."""
        data, at = text_bytes(column)
        owner, _, _, levels = tokens(data, at)
        score, n = self.lookup(levels), len(column)
        before = np.concatenate(([0.0], np.cumsum(score)))
        ends = counts_by(owner, n)
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(n)]
        positive = np.flatnonzero(score > 0)
        for t, first, last in _runs(owner[positive]):
            where = positive[first:last]
            line = np.zeros(2 * len(where) - 1)  # what lies between two positive words counts as one step
            line[::2] = score[where]
            line[1::2] = before[where[1:]] - before[where[:-1] + 1]
            n_words = ends[t + 1] - ends[t]
            for b, e, s in segments(line.tolist()):
                out[t].append((int(where[b // 2] - ends[t]), int(where[(e - 1) // 2] - ends[t]) + 1, self.rate * s - float(np.log(self.scale * n_words))))
        return out

    def strongest(self, found: list[list[tuple[int, int, float]]]) -> np.ndarray:
        return np.array([max((s for *_, s in x), default=LOW) for x in found]).clip(LOW, HIGH)


#: Normalised scores are clipped to this range before calibration.
LOW, HIGH = -20.0, 60.0


def _runs(owner: np.ndarray):
    head = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else []
    for k, first in enumerate(head):
        yield int(owner[first]), int(first), int(head[k + 1]) if k + 1 < len(head) else len(owner)


def _token_counts(batches):
    """(key, docs and words with it, in toxic and in other documents), summed over a task."""
    empty = np.zeros((0, 4))
    keys, sums = np.zeros(0, np.uint64), empty
    for part in slices(batches):
        data, at = text_bytes(part.column("text"))
        owner, _, _, levels = tokens(data, at)
        toxic = part.column("y").to_numpy()[owner] if len(owner) else np.zeros(0, int)
        key = np.concatenate([*levels, np.ones(len(owner), np.uint64)])  # 1: any word
        who, bad = np.tile(owner, len(levels) + 1), np.tile(toxic, len(levels) + 1)
        order = np.lexsort((who, key))
        key, who, bad = key[order], who[order], bad[order]
        new_doc = np.concatenate(([True], (key[1:] != key[:-1]) | (who[1:] != who[:-1]))) if len(key) else np.zeros(0, bool)
        ones = np.ones(len(key))
        rows = np.stack([new_doc * bad, new_doc * (1 - bad), bad, ones - bad], 1).astype(float)
        key, rows = np.concatenate((keys, key)), np.concatenate((sums, rows))
        keys, place = np.unique(key, return_inverse=True)
        sums = np.stack([np.bincount(place, rows[:, k], len(keys)) for k in range(4)], 1)
    use = keys > 0
    yield pa.RecordBatch.from_arrays([pa.array(keys[use].view(np.int64)), *(pa.array(sums[use, k]) for k in range(4))], ["key", "docs1", "docs0", "n1", "n0"])


def train(docs: DataFrame, sample: DataFrame) -> SegmentModel:
    """Fit on a labelled_sample(): log-odds on folds 0 to 2, extreme values and calibration on 3."""
    rows = stored(with_labels(docs, sample), "toxicity-train")
    counts = rows.where("fold < 3").select("text", "y").mapInArrow(_token_counts, "key bigint, docs1 double, docs0 double, n1 double, n0 double")
    counts = counts.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("docs1", "docs0", "n1", "n0")))
    counts = stored(counts, "toxicity-counts")
    everything = counts.where("key = 1").first()
    if not everything or not everything["n1"] or not everything["n0"]:
        return SegmentModel()
    n1, n0 = everything["docs1"], everything["docs0"]
    # documents with the token count, lest one that repeats a word weigh more; the prior of a token is its share of all documents
    prior = F.lit(PRIOR) * (F.col("docs1") + F.col("docs0")) / (n1 + n0)
    a, b = F.col("docs1") + prior * n1 / (n1 + n0), F.col("docs0") + prior * n0 / (n1 + n0)
    odds = F.log(a / (n1 + PRIOR * n1 / (n1 + n0) - a + 0.5)) - F.log(b / (n0 + PRIOR * n0 / (n1 + n0) - b + 0.5))
    z = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    often = F.when(odds > 0, F.col("docs1")).otherwise(F.col("docs0"))
    known = counts.where((F.col("key") != 1) & (often >= LEAST_DOCS)).select("key", F.greatest(F.least(odds, F.lit(12.0)), F.lit(-12.0)).alias("odds"), z.alias("z"))
    # whoever trains bounds the sample, and so its distinct tokens: none is left out
    best = known.where((F.abs("z") >= LEAST_Z) & (F.abs("odds") >= LEAST_ODDS)).select("key", "odds").toArrow()
    keys, odds = (best.column(c).to_numpy() for c in ("key", "odds"))
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    model = SegmentModel(keys[order], odds[order])
    model.rate, model.scale = _extreme_values(rows.where("fold = 3 AND y = 0"), model)

    def score(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.strongest(model.passages(part.column("text")))), part.column("y"), part.column("weight")], ["raw", "y", "weight"])

    model.curve = isotonic(rows.where("fold = 3").select("text", "y", "weight").mapInArrow(score, "raw double, y int, weight double"), "raw", LOW, HIGH)
    return model


def _extreme_values(null: DataFrame, model: SegmentModel) -> tuple[float, float]:
    """lambda and K from the words' scores in non-toxic documents.

    lambda solves sum p(s) exp(lambda s) = 1 over the histogram of scores; K is the share of
    words at which a positive segment may begin.
    """

    def histogram(batches):
        total = np.zeros(2600)
        for part in slices(batches):
            s = model.lookup(tokens(*text_bytes(part.column("text")))[3])
            total += np.bincount(np.clip(np.round((s + 13) * 100), 0, 2599).astype(int), minlength=2600)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bin", "n"])

    rows = null.select("text").mapInArrow(histogram, "bin bigint, n double").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return 1.0, 1.0
    s, n = np.array([r["bin"] / 100 - 13 for r in rows]), np.array([r["n"] for r in rows])
    s, p = np.append(s, 1.0), np.append(n, 0.5) / (n.sum() + 0.5)  # half a word of score 1, lest lambda be infinite
    low, high = 1e-6, 50.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if np.log(p @ np.exp(middle * (s - s.max()))) + middle * s.max() < 0 else (low, middle)
    return max(low, 1e-3), max(float(p[s > 0].sum()), 1e-6)


def score_toxicity(docs: DataFrame, model: SegmentModel, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, the probability of a toxic text, and its significant passages.

    A passage has its first word, the word after its last, its E-value, and its words.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value

        def each(part):
            found = model.passages(part.column(text))
            score = model.curve(model.strongest(found)) if model.curve else np.zeros(part.num_rows)
            data, at = text_bytes(part.column(text))
            passages, starts = [], None
            for t, x in enumerate(found):
                some = [(b, e, float(np.exp(min(50, -s)))) for b, e, s in x if np.exp(min(50, -s)) < SIGNIFICANT]
                if some and starts is None:
                    _, owner, begin, end = words(data, at)
                    starts = counts_by(owner, len(at) - 1)
                passages.append([{"begin": b, "end": e, "e_value": v, "text": data[begin[starts[t] + b] : end[starts[t] + e - 1]].tobytes().decode()} for b, e, v in some])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("e_value", pa.float64()), ("text", pa.string())]))
            return {"score": pa.array(score), "passages": pa.array(passages, kind)}

        return each

    return over_texts(docs, keep, "score double, passages array<struct<begin:bigint,end:bigint,e_value:double,text:string>>", make, text)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, labelled_sample(table(spark, sf_dir, "labels"), "toxic", not_remainder(4, 2), TRAIN_DOCS))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    found = score_toxicity(docs, model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
