"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a document's characters, words and lines are standardised and mapped to random
Fourier features, which approximate a Gaussian kernel. Each task sums its part of the normal
equations; the sums are added by a shuffle, and the driver solves one small system.

A null text counts as empty. Every text gets a score. Repeated documents get equal scores.
Without labelled rows every score is 0.5. A task holds some arrays of 8 bytes for each byte of a slice of 2 MB of
text, or of one longer text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import counts_by, mix, over_texts, shingles, text_bytes, words
from corpusloom.llm.calibration import Isotonic, isotonic, labelled_sample, not_remainder, with_labels
from corpusloom.llm.langid import remainder
from corpusloom.session import stored, table

#: At most about so many labelled documents of each class train the model.
TRAIN_DOCS = 8000
#: Random features, kernel width (in standard deviations), ridge.
FEATURES, WIDTH, RIDGE, SEED = 192, 3.0, 1e-3, 11
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" \t\r", "line": b"\n",
    "stop": b".,;:?'\"()-", "bang": b"!", "bar": b"|", "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
}
STATISTICS = ["chars", *_CLASSES, "high", "uppercase", "word_mean", "word_spread", "same_next", "repeats", "top_word", "distinct", "line_mean"]


def _distinct(hashed: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: distinct values, and how often the most frequent one occurs."""
    key = np.sort(mix(hashed + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(~((1 << 20) - 1) & (1 << 64) - 1) | (owner & ((1 << 20) - 1)).astype(np.uint64))
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    run = np.diff(np.append(head, len(key)))
    who = (key[head] & np.uint64((1 << 20) - 1)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, who, run)
    return np.bincount(who, minlength=n), most


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    data, at = text_bytes(column)
    n, size = len(column), np.diff(at)
    owner_of = lambda where: np.bincount(np.searchsorted(at, where, "right") - 1, minlength=n)
    code = np.zeros(256, np.uint8)
    for k, chars in enumerate(_CLASSES.values(), 1):
        code[list(chars)] = k
    code[128:] = len(_CLASSES) + 1
    kinds = code[data]
    counts = np.stack([owner_of(np.flatnonzero(kinds == k)) for k in range(1, len(_CLASSES) + 2)], 1).astype(float)
    some = np.maximum(1, size)[:, None]
    hashed, owner, begin, end = words(data, at)
    n_words = np.bincount(owner, minlength=n)
    some_words = np.maximum(1, n_words)
    length = (end - begin).astype(float)
    mean = np.bincount(owner, length, n) / some_words
    spread = np.sqrt(np.maximum(0, np.bincount(owner, length**2, n) / some_words - mean**2))
    same = np.bincount(owner[1:][(hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])], minlength=n) if len(owner) else np.zeros(n)
    grams, who = shingles(hashed, owner, n, 3)
    distinct, _ = _distinct(grams, who, n)
    words_distinct, top = _distinct(hashed, owner, n)
    upper, lower = counts[:, 0], counts[:, 1]
    return np.column_stack([
        np.log1p(size), np.sqrt(counts / some), upper / np.maximum(1, upper + lower), mean, spread, same / some_words,
        1 - distinct / np.maximum(1, np.bincount(who, minlength=n)), top / some_words, words_distinct / some_words**0.8, np.log1p(size / (counts[:, 4] + 1)),
    ])


@dataclass
class Kernel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None = None
    curve: Isotonic | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w, b = rng.normal(0, 1 / WIDTH, (x.shape[1], FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.column_stack([np.ones(len(x)), np.sqrt(2 / FEATURES) * np.cos(z @ w + b)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        # rounded, as a matrix product may differ in the last digit from row to row
        return np.round(self.features(x) @ self.weights, 9) if self.weights is not None else np.zeros(len(x))


def _sums(rows: DataFrame, terms) -> dict[int, float]:
    """Sums over all rows of each entry of terms(x, y, weight), first within tasks, then between them."""

    def each(batches):
        total = None
        for b in batches:
            if b.num_rows:
                x = np.array(b.column("x").to_pylist(), float)
                t = terms(x, b.column("y").to_numpy(), b.column("weight").to_numpy())
                total = t if total is None else total + t
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    return {r["k"]: r["v"] for r in rows.mapInArrow(each, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}


def train(docs: DataFrame, sample: DataFrame) -> Kernel:
    """Fit on a labelled_sample(): ridge on folds 0 to 2, calibration on fold 3."""
    width = len(STATISTICS)
    rows = over_texts(with_labels(docs, sample), ["y", "weight", "fold"], "x array<double>", lambda: lambda part: {"x": pa.array(list(statistics(part.column("text"))), pa.list_(pa.float64()))})
    rows = stored(rows.coalesce(8), "quality-train")
    part = rows.where("fold < 3")
    s = _sums(part, lambda x, y, w: np.concatenate(([w.sum()], w @ x, w @ x**2)))
    if not s or s[0] == 0:
        return Kernel(np.zeros(width), np.ones(width))
    mean = np.array([s[1 + k] for k in range(width)]) / s[0]
    spread = np.sqrt(np.maximum(1e-6, np.array([s[1 + width + k] for k in range(width)]) / s[0] - mean**2))
    model = Kernel(mean, spread)
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def normal(x, y, w):
        z = model.features(x)
        return np.concatenate((((z * w[:, None]).T @ z)[upper], (z * w[:, None]).T @ y))

    s = _sums(part, normal)
    v = np.array([s[k] for k in range(len(s))])
    gram = np.zeros((size, size))
    gram[upper] = v[: len(upper[0])]
    gram = gram + gram.T - np.diag(gram.diagonal())
    model.weights = np.linalg.solve(gram + RIDGE * np.trace(gram) / size * np.eye(size), v[len(upper[0]) :])

    def score(batches):
        for b in batches:
            x = np.array(b.column("x").to_pylist(), float).reshape(b.num_rows, width)
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(x)), b.column("y"), b.column("weight")], ["raw", "y", "weight"])

    model.curve = isotonic(rows.where("fold = 3").mapInArrow(score, "raw double, y int, weight double"), "raw", -0.5, 1.5)
    return model


def score_quality(docs: DataFrame, model: Kernel, keep: list[str], text: str = "text", into: str = "score") -> DataFrame:
    """The kept columns and the probability of a good document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value
        return lambda part: {into: pa.array(model.curve(model.raw(statistics(part.column(text)))) if model.curve else np.full(part.num_rows, 0.5))}

    return over_texts(docs, keep, f"`{into}` double", make, text, limit=2 << 20)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, labelled_sample(table(spark, sf_dir, "labels"), "quality", not_remainder(5, 0), TRAIN_DOCS))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return score_quality(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
