"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside the tasks, sums them with a shuffle keyed by
(language, bucket), and broadcasts the log-probability matrix, of LANGUAGES_AT_ONCE languages at a time. Scoring gathers the rows of a
text's n-grams and adds them up; a text's length only changes how many rows are added.

A null text, or one without a letter, is ``und`` with score 0. Rows with a null language train
nothing. Repeated rows count as often as they occur. Without any labelled row every text is
``und``. A task holds some arrays of 8 bytes for each character of the slice that it works on, or of one
longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import code_points, counts_by, mix, over_texts, slices, text_bytes
from corpusloom.session import stored, table

UNDETERMINED = "und"
#: Orders of the n-grams, and buckets that their hashes fall into.
ORDERS, BUCKETS = (1, 2, 3, 4), 1 << 16
#: At most about so many labelled documents of each language train the model.
TRAIN_DOCS = 4000
#: Languages of which the matrix is held and broadcast at once (134 MB); more are scored in several turns.
LANGUAGES_AT_ONCE = 512
#: Rates of so many labels are broadcast.
BROADCAST_LABELS = 100_000
#: Bytes of text that a task turns into n-grams at once, or one longer text.
SLICE = 1 << 18
#: Long texts count as if they had this many n-grams, so that scores don't all saturate.
EVIDENCE = 60.0
SMOOTHING = 0.5


def _folded() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower case (if that is one code point), or a space for what is no letter."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(len(points), bool)
    for begin, end in ((0, 0x33480), (0xA000, 0x20000)):  # planes with letters that have case or are scanned below
        for p in range(begin, min(end, len(points))):
            letter[p] = chr(p).isalpha()
    letter[0x20000:0x33480] = [chr(p).isalpha() for p in range(0x20000, 0x33480)]
    for p in np.flatnonzero(letter[:0x1F000]):
        low = chr(p).lower()
        if len(low) == 1:
            points[p] = ord(low)
    points[~letter] = 32
    return points, letter


_tables: list[np.ndarray] = []


def grams(column: pa.Array, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text of each, and whether a text has a letter.

    Runs of characters other than letters count as one space, so n-grams reach over the edge
    of a word but not into another one.
    """
    if not _tables:
        _tables.extend(_folded())
    points, at = code_points(*text_bytes(column))
    n = len(column)
    owner = np.repeat(np.arange(n), np.diff(at))
    has_letter = np.zeros(n, bool)
    is_letter = _tables[1][points]
    has_letter[owner[is_letter]] = True
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # of what follows a letter, the first stands for the gap
    keep[at[:-1][np.diff(at) > 0]] = True
    x, owner = _tables[0][points][keep].astype(np.uint64), owner[keep]
    out, who = [], []
    key = np.zeros(len(x), np.uint64)
    for size in range(1, max(orders) + 1):
        m = len(x) - size + 1
        if m <= 0:
            break
        key = key[:m] * np.uint64(0x100000001B3) + x[size - 1 :]
        if size in orders:
            whole = owner[:m] == owner[size - 1 :]
            if size == 1:
                whole &= x != 32
            elif size > 2:
                for j in range(1, size - 1):
                    whole &= x[j : m + j] != 32
            out.append((mix(key[whole] + np.uint64(size)) & np.uint64(buckets - 1)).astype(np.int64))
            who.append(owner[:m][whole])
    return np.concatenate(out or [np.zeros(0, np.int64)]), np.concatenate(who or [np.zeros(0, np.int64)]), has_letter


@dataclass
class NaiveBayes:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages, float32
    log_prior: np.ndarray

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: the likeliest of these languages, its tempered log-probability, and what all of them weigh beside it.

        A text without a letter weighs 0. The posterior of the likeliest is 1 by the weight.
        """
        n = len(column)
        bucket, who, has_letter = grams(column, buckets=len(self.log_probability))
        total = np.stack([np.bincount(who, self.log_probability[bucket, k], n) for k in range(len(self.languages))], 1)
        seen = np.bincount(who, minlength=n)
        total = total * np.minimum(1, EVIDENCE / np.maximum(1, seen))[:, None] + self.log_prior
        top = total.max(1)
        return total.argmax(1), top, np.where(has_letter, np.exp(total - top[:, None]).sum(1), 0)


def balanced_sample(labelled: DataFrame, label: str, key: Column, per_label: int) -> DataFrame:
    """About per_label rows of each label, all if there are fewer; drawn by a hash of the key."""
    counts = labelled.groupBy(F.col(label).alias("_label")).agg(F.least(F.lit(1.0), per_label / F.count("*")).alias("_rate"))
    rates = stored(counts, "label-rates")
    few = rates.count() <= BROADCAST_LABELS
    drawn = labelled.join(F.broadcast(rates) if few else rates, F.col(label) == F.col("_label"))
    return drawn.where(F.pmod(F.xxhash64(key), F.lit(1_000_003)) < F.col("_rate") * 1_000_003).drop("_label", "_rate")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = TRAIN_DOCS) -> Counts:
    """Count n-grams of at most about per_language labelled rows of each language."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key")).where("lang IS NOT NULL AND text IS NOT NULL")
    sample = balanced_sample(rows, "lang", F.col("key"), per_language).select("text", "lang")

    def count(batches):
        """One row for each language and task: sums over the whole partition."""
        total: dict[str, np.ndarray] = {}
        for part in slices(batches, limit=SLICE):
            bucket, who, _ = grams(part.column("text"))
            names = part.column("lang").to_pylist()
            code = {x: k for k, x in enumerate(dict.fromkeys(names))}
            of = np.array([code[x] for x in names], np.int64)[who]
            sums = np.bincount(of * BUCKETS + bucket, minlength=len(code) * BUCKETS).reshape(len(code), BUCKETS)
            for x, k in code.items():
                total[x] = total.get(x, 0) + sums[k]
        for x, v in total.items():
            some = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(some), pa.string()), pa.array(some), pa.array(v[some])], ["lang", "bucket", "n"])

    sums = sample.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = stored(sums, "n-grams")
    return Counts(sums, [r[0] for r in sums.select("lang").distinct().orderBy("lang").collect()])


@dataclass
class Counts:
    """What a model is made of: (lang, bucket, n), stored, and the languages."""

    sums: DataFrame
    languages: list[str]

    def models(self, at_once: int) -> Iterator[NaiveBayes]:
        """Models of so many languages each, in order; all priors are equal."""
        for k in range(0, len(self.languages), at_once):
            some = self.languages[k : k + at_once]
            place = {x: j for j, x in enumerate(some)}
            counts = np.full((BUCKETS, len(some)), SMOOTHING, np.float32)
            rows = self.sums.where(F.col("lang").between(some[0], some[-1])) if len(some) < len(self.languages) else self.sums
            found = rows.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))  # BUCKETS entries each at most
            for r in found.toLocalIterator():
                pairs = np.array(r["counts"], np.int64).reshape(-1, 2)
                counts[pairs[:, 0], place[r["lang"]]] += pairs[:, 1]
            yield NaiveBayes(some, np.log(counts / counts.sum(0, dtype=np.float64)).astype(np.float32), np.full(len(some), -np.log(len(self.languages))))


def identify(docs: DataFrame, counts: Counts, keep: list[str], text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The kept columns with the predicted language and its score (0 to 1).

    Of more than LANGUAGES_AT_ONCE languages, some are scored at a time, and each turn's likeliest and the weight of
    the others are stored with the documents for the next turn.
    """
    if set(into) & set(keep):
        raise ValueError(f"columns of the input have names of results: {sorted(set(into) & set(keep))}")
    names, kept = ("_lang", "_top", "_weight"), [f"c{k}" for k in range(len(keep))]
    mine = kept[keep.index(text)] if text in keep else "_text"
    docs = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, kept)), *([] if text in keep else [F.col(f"`{text}`").alias(mine)]))
    several = len(counts.languages) > LANGUAGES_AT_ONCE
    state = [F.lit(None).cast("string"), F.lit(float("-inf")), F.lit(0.0)]
    for turn, model in enumerate(counts.models(LANGUAGES_AT_ONCE)):
        held = docs.sparkSession.sparkContext.broadcast(model)

        def make(held=held):
            model = held.value

            def each(part):
                best, top, weight = model.score(part.column(mine))
                return {"_lang1": pa.array(model.languages, pa.string()).take(pa.array(best)), "_top1": pa.array(top), "_weight1": pa.array(weight)}

            return each

        more = over_texts(docs, docs.columns if several else kept, "_lang1 string, _top1 double, _weight1 double", make, mine, limit=SLICE)
        if not turn:
            docs = more.withColumnsRenamed({f"{n}1": n for n in names})
        else:
            better = F.col("_top1") > F.col("_top")
            apart = F.exp(-F.abs(F.col("_top1") - F.col("_top")))
            weight = F.when(better, F.col("_weight1") + F.col("_weight") * apart).otherwise(F.col("_weight") + F.col("_weight1") * apart)
            chosen = [F.when(better, F.col("_lang1")).otherwise(F.col("_lang")), F.greatest("_top", "_top1"), weight]
            docs = more.select(*dict.fromkeys([*kept, mine]), *(c.alias(n) for c, n in zip(chosen, names)))
        if several:
            docs = stored(docs, "languages")
        state = [F.col(n) for n in names]
    lang, _, weight = state
    made = F.when(weight > 0, lang).otherwise(UNDETERMINED), F.when(weight > 0, 1 / weight).otherwise(0.0)
    return docs.select(*(F.col(n).alias(c) for c, n in zip(keep, kept)), *(c.alias(n) for c, n in zip(made, into)))


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo by."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = train(docs.where(~held_out))
    return identify(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Pipeline stage: drop documents without letters, and those whose language stays doubtful; columns may have any names."""
    model = train(docs.where(~F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))))
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)))
    found = identify(plain, model, plain.columns, f"c{docs.columns.index('text')}")
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))
