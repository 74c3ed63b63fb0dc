"""Periodic runs of words, by the runs theorem.

A run is a maximal stretch of consecutive words whose smallest period is at most half its length.
Every run holds a Lyndon root: a stretch of one period that is the longest Lyndon word from its
first position on, under the order of words or under the reversed one (Bannai et al., 2017).
The longest Lyndon word at i ends before the next position whose suffix is smaller, so next
smaller (and next greater) values of the inverse suffix array give at most two candidates a
position. Each is extended as far as its period holds: to the right by the longest common prefix of two
suffixes, a minimum over a range of the LCP array; to the left by the same, as k words to the left
agree if and only if the suffixes that begin k words earlier share k words or more. So all runs
of n words take O(n log n) steps and memory of some multiples of n, however periodic the text.

Suffixes are sorted by prefix doubling, all texts of a slice at once; only suffixes that are not
told apart yet are sorted again. Words are compared whole, not by hashes.

Memory of a task follows its slice of texts (1 MB), or its longest text: about 250 bytes a word.
Null texts have no words. Texts without words have no runs and collapse to the empty text.
Repeated rows give repeated results; columns that aren't kept are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import counts_by, over_texts, split_words, text_bytes, word_dictionary
from corpusloom.session import table

#: Runs of fewer words are not reported.
LEAST = 12
BLOCK = 16
_MOST = np.iinfo(np.int64).max
_IN_WORDS = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class RangeMin:
    """Minima over ranges of an array, and first positions below a value, by a sparse table over blocks."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        padded = np.concatenate((values, np.full(-self.n % BLOCK, _MOST))).astype(np.int64)
        self.blocks = padded.reshape(-1, BLOCK)
        self.from_left = np.minimum.accumulate(self.blocks, 1).reshape(-1)
        self.to_right = np.minimum.accumulate(self.blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
        self.levels = [self.blocks.min(1)] if self.n else []
        while self.levels and len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            wide = 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(self.levels[-1][:-wide], self.levels[-1][wide:]))

    def minimum(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value of each range [low, high), none of them empty."""
        first, last = low // BLOCK, (high - 1) // BLOCK
        out = np.minimum(self.to_right[low], self.from_left[high - 1])
        one = np.flatnonzero(first == last)
        if len(one):
            at = np.arange(BLOCK)
            inside = (at >= (low[one] % BLOCK)[:, None]) & (at <= ((high[one] - 1) % BLOCK)[:, None])
            out[one] = np.where(inside, self.blocks[first[one]], _MOST).min(1)
        span = last - first - 1
        level = np.frexp(np.maximum(span, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[span > 0]):
            some = np.flatnonzero((span > 0) & (level == k))
            row = self.levels[k]
            between = np.minimum(row[first[some] + 1], row[last[some] - (1 << int(k))])
            out[some] = np.minimum(out[some], between)
        return out

    def first_below(self, start: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The first position from start on whose value is less, or n."""
        out = np.full(len(start), self.n, np.int64)
        todo = np.flatnonzero(start < self.n)
        block = start[todo] // BLOCK
        hit = (self.blocks[block] < value[todo, None]) & (np.arange(BLOCK) >= (start[todo] % BLOCK)[:, None])
        found = hit.any(1)
        out[todo[found]] = block[found] * BLOCK + hit[found].argmax(1)
        todo, block = todo[~found], block[~found] + 1
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            fits = block < len(row)
            skip = fits & (row[np.where(fits, block, 0)] >= value[todo])
            block = block + (skip.astype(np.int64) << k)
        some = block < len(self.blocks)
        todo, block = todo[some], block[some]
        hit = self.blocks[block] < value[todo, None]
        out[todo] = block * BLOCK + hit.argmax(1)
        return np.minimum(out, self.n)


def suffix_order(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every suffix (texts one after another, each ranked among its own), and the LCP array.

    ids are the words of all texts, at the n + 1 offsets of the texts. lcp[k] is what the suffixes of
    ranks k - 1 and k share. A suffix that is the beginning of another is the smaller.
    """
    n = len(ids)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = at[1:][owner]
    key = owner * (int(ids.max()) + 1 if n else 1) + ids
    order = np.argsort(key, kind="stable")
    head = np.ones(n + 1, bool)
    head[1:n] = key[order[1:]] != key[order[:-1]]
    lcp = np.where(head[:n], 0, _MOST)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head[:n], np.arange(n), 0))
    undecided = np.flatnonzero(~(head[:n] & head[1:]))
    shared = 1
    while len(undecided):
        known = RangeMin(lcp)
        who = order[undecided]
        then = who + shared
        second = np.where(then < end[who], rank[np.minimum(then, n - 1)], -1)
        by = np.lexsort((second, rank[who]))
        who, second = who[by], second[by]
        group = rank[who]
        order[undecided] = who
        same = group[1:] == group[:-1]
        parts = np.flatnonzero(same & (second[1:] != second[:-1])) + 1
        low, high = second[parts - 1], second[parts]
        more = np.zeros(len(parts), np.int64)
        real = low >= 0
        more[real] = known.minimum(low[real] + 1, high[real] + 1)
        lcp[undecided[parts]] = shared + more
        starts = np.concatenate(([True], ~same, [True]))
        starts[parts] = True
        rank[who] = np.maximum.accumulate(np.where(starts[:-1], undecided, 0))
        undecided = undecided[~(starts[:-1] & starts[1:])]
        shared *= 2
    return rank, lcp


def find_runs(ids: np.ndarray, at: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start (in the text), length and period of all runs of at least that many words, in order of start and period."""
    n = len(ids)
    if not n:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    begin, end = at[:-1][owner], at[1:][owner]
    rank, lcp = suffix_order(ids, at)
    table_of = RangeMin(lcp)

    def common(i, j):
        a, b = rank[i], rank[j]
        return table_of.minimum(np.minimum(a, b) + 1, np.maximum(a, b) + 1)

    found = []
    for sign in (1, -1):
        # later texts are below all of this one, so the search ends with the text
        value = sign * (rank - begin) - owner * (2 * n)
        after = RangeMin(value).first_below(np.arange(1, n + 1), value)
        i = np.flatnonzero((after < end) & (ids[np.minimum(after, n - 1)] == ids))
        j = after[i]
        period, ahead = j - i, common(i, j)
        # the fewest words to the left that make it a run of the length that is asked for
        need = np.maximum(0, np.maximum(least - period, period) - ahead)
        some = np.flatnonzero(need <= i - begin[i])
        some = some[(need[some] == 0) | (common(i[some] - need[some], j[some] - need[some]) >= need[some])]
        i, j, period, ahead, back = i[some], j[some], period[some], ahead[some], need[some]
        most = i - begin[i]
        while len(open_ := np.flatnonzero(back < most)):
            middle = (back[open_] + most[open_] + 1) // 2
            holds = common(i[open_] - middle, j[open_] - middle) >= middle
            back[open_[holds]] = middle[holds]
            most[open_[~holds]] = middle[~holds] - 1
        found.append(np.stack((i - back, period, back + period + ahead), 1))
    start, period, length = np.unique(np.concatenate(found), axis=0).T
    return owner[start], start - begin[start], length, period


def joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray, keep: np.ndarray, at: np.ndarray) -> pa.Array:
    """For each text, the kept words with one space between them."""
    begin, size = begin[keep], end[keep] - begin[keep] + 1
    words_at = np.concatenate(([0], np.cumsum(keep)))[at]
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.concatenate((data, [0x20]))[np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])].astype(np.uint8)
    out[offsets[1:] - 1] = 0x20
    # no space after the last word of a text
    last = offsets[words_at[1:][np.diff(words_at) > 0]] - 1
    ended = np.concatenate(([0], np.cumsum(np.diff(words_at) > 0)))
    out = np.delete(out, last)
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(offsets[words_at] - ended), pa.py_buffer(out)])


def with_runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = LEAST) -> DataFrame:
    """The kept columns, the runs of at least that many words, and the text in which each run is cut to one period.

    runs is in order of start and period. A word goes if any run contains it after the run's first period;
    the words that stay are joined by single spaces.
    """

    def make():
        def each(part):
            data, at_bytes = text_bytes(part.column(text))
            begin, end, at = split_words(_IN_WORDS[data], at_bytes)
            ids = word_dictionary(data, begin, end).indices.to_numpy().astype(np.int64)
            who, start, length, period = find_runs(ids, at, least)
            gone = np.zeros(len(begin) + 1, np.int64)
            np.add.at(gone, at[who] + start + period, 1)
            np.add.at(gone, at[who] + start + length, -1)
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            return {
                "n_words": pa.array(np.diff(at)),
                "runs": pa.ListArray.from_arrays(pa.array(counts_by(who, part.num_rows), pa.int32()), runs),
                "collapsed": joined(data, begin, end, np.cumsum(gone[:-1]) == 0, at),
            }

        return each

    return over_texts(docs, keep, "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string", make, text, limit=1 << 20)


def _repeating(key: Column, text: Column) -> Column:
    """The text of the contract: of one key in ten, the words from a certain one on repeat a certain number of words."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of(x: Column) -> Column:
        n = F.size(x)
        a = F.pmod(g, n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(x, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(x, 1, a), F.slice(tail, 1, n - a)), " "))

    # bound as a lambda's variable, so a text is split once
    made = F.element_at(F.transform(F.array(words), of), 1)
    return F.when(h % 10 == 0, made).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id has no checksum: its text is taken as it is."""
    docs = table(spark, sf_dir, "documents")
    found = with_runs(docs.select("doc_id", _repeating(F.col("doc_id"), F.col("text")).alias("text")), ["doc_id"])
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("period"))))
    found = found.withColumn("top", top)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("(1000 * top.length) div (-top.period)").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
