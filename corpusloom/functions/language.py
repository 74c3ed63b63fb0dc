"""The language of a text, by a naive Bayes model over its character trigrams that is read from a file.

The model file is a Parquet table (lang, gram, n): how often each trigram (three code points in one number)
occurs in the training texts of a language; ``train`` writes one from labelled texts. Weights are whole numbers,
floor(1000 ln ((n + 1) / (N + G))) with N trigrams of the language and G distinct ones in all, so results don't depend on the
order of additions. Equal sums go to the first language by name. A null text, and one of fewer than three characters, has no language (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are cut into trigrams by so many bytes at once, or one text.
SLICE_BYTES = 2 << 20
MODEL = "lang string, gram bigint, n bigint"


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams and the text of each; null is as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    points = np.frombuffer("".join(t.as_py() for t in texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = pc.utf8_length(texts).to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = owner[:-2] == owner[2:]
    return ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[whole], owner[:-2][whole]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield texts.slice(at, to - at)
        at = to


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", least: int = 1) -> DataFrame:
    """The model table of all labelled texts; trigrams that occur fewer than least times in a language are left out of it."""

    def count(batches):
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            at = 0
            for part in _slices(batch.column("text")):
                gram, owner = trigrams(part)
                of = names.indices.to_numpy()[at : at + len(part)][owner]
                for code in np.unique(of):
                    some, n = np.unique(gram[of == code], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([names.dictionary[int(code)].as_py()] * len(some), pa.string()), pa.array(some), pa.array(n)], ["lang", "gram", "n"])
                at += len(part)

    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(count, MODEL).groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class LanguageModel:
    """Weights of trigrams by language; the last row is that of trigrams which the model lacks."""

    def __init__(self, rows: pa.Table):
        names = rows.column("lang").combine_chunks().dictionary_encode()
        self.languages = sorted(names.dictionary.to_pylist())
        place = np.array([self.languages.index(x) for x in names.dictionary.to_pylist()], np.int64)
        self.grams, row = np.unique(rows.column("gram").to_numpy(), return_inverse=True)
        counts = np.zeros((len(self.grams) + 1, len(self.languages)), np.int64)
        counts[row, place[names.indices.to_numpy()]] = rows.column("n").to_numpy()
        self.weights = np.floor(1000 * np.log((counts + 1) / (counts.sum(0) + len(self.grams)))).astype(np.int64)

    def languages_of(self, texts: pa.Array) -> pa.Array:
        gram, owner = trigrams(texts)
        if not self.languages:
            return pa.nulls(len(texts), pa.string())
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        at = np.where(self.grams[at] == gram, at, len(self.grams))
        sums = np.stack([np.bincount(owner, self.weights[at, k], len(texts)) for k in range(len(self.languages))], 1)
        none = np.bincount(owner, minlength=len(texts)) == 0
        return pc.if_else(pa.array(none), pa.scalar(None, pa.string()), pa.array(self.languages, pa.string()).take(pa.array(sums.argmax(1))))


def read_model(spark: SparkSession, path: str) -> LanguageModel:
    """A model file, which is as small as its number of distinct trigrams (some ten thousands a language)."""
    return LanguageModel(spark.read.schema(MODEL).parquet(path).toArrow())


def language_of(text: Column, model: LanguageModel, spark: SparkSession) -> Column:
    """The language of the text by the model, which is broadcast; in a filter, predicates without Python go first."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            made = [model.languages_of(part) for part in _slices(batch)]
            yield pa.concat_arrays(made) if made else pa.nulls(0, pa.string())

    return classify(text)
