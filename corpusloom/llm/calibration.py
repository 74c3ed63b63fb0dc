"""Labelled samples of a stated size, and score calibration from sums over bins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.langid import remainder


def labelled_sample(labels: DataFrame, label: str, use: Column, bound: int, key: str = "doc_id") -> DataFrame:
    """(key, y, weight, fold): at most about bound labelled rows of each class that use admits.

    Rows are drawn by a hash of the key; weight is the inverse of the class's rate, so weighted
    sums stand for all rows. fold (0 to 3) is another hash. Rows without a label or key go.
    """
    rows = labels.select(F.col(key).alias("key"), (F.col(label) > 0).cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("key").isNotNull() & use)
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = [min(1.0, bound / max(1, n.get(y, 0))) for y in (0, 1)]
    rate_of = F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])
    drawn = rows.where(F.pmod(F.xxhash64("key"), F.lit(1_000_003)) < rate_of * 1_000_003)
    return drawn.select("key", "y", (1 / rate_of).alias("weight"), F.pmod(F.xxhash64("key", F.lit(7)), F.lit(4)).alias("fold"))


def not_remainder(by: int, out: int) -> Column:
    return F.coalesce(remainder("key", by) != out, F.lit(False))


def with_labels(docs: DataFrame, sample: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, y, weight, fold) of the sampled documents, equal texts once for each class, with the fold of the least key.

    The sample is of a stated size, hence broadcast.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key")
    least = F.min(F.struct("key", "weight", "fold")).alias("least")
    return rows.groupBy("text", "y").agg(least).select("text", "y", "least.weight", "least.fold")


class Isotonic:
    """A non-decreasing map from raw scores to probabilities."""

    def __init__(self, x: np.ndarray, p: np.ndarray):
        self.x, self.p = x, p

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.x):
            return np.full(len(raw), 0.5)
        return np.clip(np.interp(raw, self.x, self.p), 0, 1)


def isotonic(scored: DataFrame, raw: str, low: float, high: float, bins: int = 1024) -> Isotonic:
    """Fit by pooling adjacent violators over equal bins of raw scores.

    scored has raw, y and weight. Only sums of each bin reach the driver. Two pseudo-rows, one
    of either class, keep the outermost probabilities off 0 and 1.
    """
    bin_ = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(raw) - low) / (high - low) * bins)))
    rows = scored.groupBy(bin_.alias("bin")).agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("y")).alias("s"), F.sum(F.col("weight") * F.col(raw)).alias("x")).orderBy("bin").collect()
    if not rows:
        return Isotonic(np.zeros(0), np.zeros(0))
    blocks: list[list[float]] = []
    for r in rows:
        blocks.append([r["w"], r["s"], r["x"]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return Isotonic(b[:, 2] / b[:, 0], (b[:, 1] + 0.5) / (b[:, 0] + 1))
