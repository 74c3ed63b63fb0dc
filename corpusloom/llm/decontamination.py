"""Benchmark decontamination by suffix arrays over the training texts.

Each slice of documents is a shard: its words, with a separator after every document, get a
suffix array. Every suffix of every benchmark item is then binary-searched in it by its first
window; windows that occur several times in the benchmark are searched once. Shards need nothing
of each other, so the documents are scanned once and never shuffled.

What is hit, and what hits it, is then put in one suffix order at full depth. There, the
neighbours of a document's suffix among the benchmark's suffixes give its longest verbatim match
and where that is. Work and memory grow with the words of the shard and of the benchmark's hit
parts, not with the number of pairs of places, so long repetitions on both sides do no harm.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
one window. Null texts have no words; items without an id or without words match nothing;
repeated item rows count once; repeated documents are each judged. An empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import counts_by, mix, over_texts, words_of
from corpusloom.session import stored, table

WINDOW = 13
#: A block of the benchmark is broadcast; it holds about so many bytes of text.
BLOCK_BYTES = 4 << 20
#: Bytes of text of a shard, or one longer text.
SHARD_BYTES = 1 << 20
SPANS = "array<struct<begin:bigint,end:bigint>>"
MATCHES = "array<struct<item_id:string,doc_word:bigint,item_word:bigint,n_words:bigint>>"


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of words, sorted by the depth words (at least) from there on; ends sort first.

    Prefix multiplication: ranks of short prefixes are packed, two or three in a key, into
    ranks of longer ones; only positions that are still tied are sorted again.
    """
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    bits = int(n + 1).bit_length()
    pack = 3 if 3 * bits <= 63 else 2
    order, slots, step = np.arange(n), np.arange(n), 1
    first = np.zeros(n, bool)
    reached = 1
    while len(slots):
        at = order[slots]
        padded = np.concatenate((rank, np.zeros(pack * step, np.int64)))
        key = rank[at]
        for j in range(1, pack):
            key = (key << bits) | padded[at + j * step]
        by = np.argsort(key)
        order[slots] = at[by]
        key = key[by]
        first[slots] = np.concatenate(([True], key[1:] != key[:-1]))
        reached = step = step * pack
        if reached >= depth:
            break
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(1, n + 1), 0))
        tied = ~(first & np.append(first[1:], True))
        slots = np.flatnonzero(tied)
    return order


def bound(words: np.ndarray, order: np.ndarray, sought: np.ndarray, begins: np.ndarray, sizes: np.ndarray, upper: bool) -> np.ndarray:
    """For each window, how many suffixes are less than it, or with upper, less or begin with it.

    A window is sizes words of sought from begins on. words must have as many separators at its end as a
    window has words.
    """
    low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(order), np.int64)
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        at = order[middle]
        goes_up = np.full(len(live), upper)
        open_ = np.arange(len(live))
        for j in range(int(sizes.max())):
            open_ = open_[sizes[live[open_]] > j]
            if not len(open_):
                break
            a, b = words[at[open_] + j], sought[begins[live[open_]] + j]
            goes_up[open_[a < b]] = True
            goes_up[open_[a > b]] = False
            open_ = open_[a == b]
        low[live[goes_up]] = middle[goes_up] + 1
        high[live[~goes_up]] = middle[~goes_up]
        live = live[low[live] < high[live]]
    return low


def runs(begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges that cover what any of the given ranges of 0 to size covers."""
    cover = np.bincount(begin, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    edge = np.diff(np.concatenate(([False], np.cumsum(cover) > 0, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def gathered(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all ranges, one range after the other, each followed by -1; and the range of each."""
    size = end - begin + 1
    which = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + begin[which]
    return np.where(place < end[which], place, -1), which


def matching(words: np.ndarray, ends: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place that isn't sought, the length of its longest match with a sought one, and that place.

    Matches stop at ends (a mask). Ranks of 1, 2, 4, ... words are made until all differ; the sought
    suffixes next to a suffix in their order match it longest, and the ranks, from the longest down,
    tell how far.
    """
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64)
    rank[ends] = n + np.arange(int(ends.sum()))  # every end is like nothing else
    _, rank = np.unique(rank, return_inverse=True)
    levels, step = [rank.astype(np.int32)], 1
    while int(levels[-1].max(initial=0)) + 1 < n:
        r = levels[-1].astype(np.int64)
        _, rank = np.unique(r * (n + 1) + r[np.minimum(np.arange(n) + step, n - 1)], return_inverse=True)
        levels.append(rank.astype(np.int32))
        step *= 2
    order = np.argsort(levels[-1])
    mine = sought[order]
    before = np.maximum.accumulate(np.where(mine, np.arange(n), -1))
    after = np.minimum.accumulate(np.where(mine, np.arange(n), n)[::-1])[::-1]
    where = np.flatnonzero(~mine)
    place, best, at = order[where], np.zeros(n, np.int64), np.full(n, -1)
    for near in (before[where], after[where]):
        some = (near >= 0) & (near < n)
        p, q = place[some], order[near[some]]
        long = np.zeros(len(p), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            # a place at or before its own end; ends are the last to be equal to anything
            same = levels[k][np.minimum(p + long, n - 1)] == levels[k][np.minimum(q + long, n - 1)]
            long[same] += 1 << k
        better = long > best[p]
        best[p[better]], at[p[better]] = long[better], q[better]
    return best, at


class Windows:
    """The windows of some benchmark items, ready to be searched."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        hashed, owner, _, _, n = words_of(pa.array(texts, pa.string()))
        self.at = counts_by(owner, n)
        size = np.diff(self.at)
        full = np.flatnonzero(np.arange(len(hashed)) + window <= self.at[1:][owner])
        short = np.flatnonzero((size > 0) & (size < window))
        begin = np.concatenate((full, self.at[short]))
        row = np.concatenate((owner[full], short)).astype(np.int64)
        long = np.minimum(window, size[row])
        self.ids, self.window = list(dict.fromkeys(ids)), window
        place = {x: k for k, x in enumerate(self.ids)}
        self.item_of_row = np.array([place[x] for x in ids], np.int64)
        self.words = np.concatenate((np.maximum(hashed, np.uint64(1)), np.zeros(window, np.uint64)))
        # equal windows are one: each has its places in the benchmark, and its items
        key = long.astype(np.uint64)
        for j in range(window):
            key = np.where(long > j, mix(key * np.uint64(0x9E3779B97F4A7C15) + self.words[begin + np.minimum(j, np.maximum(long, 1) - 1)]), key)
        _, head, which = np.unique(key, return_index=True, return_inverse=True)
        self.begins, self.sizes = begin[head], long[head]
        by = np.argsort(which, kind="stable")
        self.places, self.places_at = begin[by], counts_by(which, len(head))
        some, item = np.divmod(np.unique(which * max(1, len(self.ids)) + self.item_of_row[row]), max(1, len(self.ids)))
        self.items, self.items_at = item, counts_by(some, len(head))

    def search(self, column: pa.Array) -> dict[str, pa.Array]:
        """n_words, hit spans, items and longest matches of each text of a shard."""
        hashed, owner, _, _, n = words_of(column)
        at = counts_by(owner, n)
        shard = np.zeros(len(hashed) + n + self.window, np.uint64)
        shard[np.arange(len(hashed)) + owner] = np.maximum(hashed, np.uint64(1))
        order = suffix_array(shard[: len(hashed) + n], self.window)
        low = bound(shard, order, self.words, self.begins, self.sizes, False)
        found = bound(shard, order, self.words, self.begins, self.sizes, True) - low
        # windows of one size share no place, so these are no more than the shard's words for each size
        hit = np.flatnonzero(found)
        which = np.repeat(hit, found[hit])
        where = order[np.repeat(low[hit], found[hit]) + _steps(found[hit])]
        text_begin = at[:-1] + np.arange(n)
        begin, end = runs(where, where + self.sizes[which], len(shard))
        text = np.searchsorted(text_begin, begin, "right") - 1
        spans = pa.StructArray.from_arrays([pa.array(begin - text_begin[text]), pa.array(end - text_begin[text])], ["begin", "end"])
        pairs = np.unique((np.searchsorted(text_begin, where, "right") - 1) * max(1, len(self.sizes)) + which)
        return {"n_words": pa.array(np.diff(at)), "spans": _lists(text, spans, n)} | self._items(pairs, n) | self._matches(shard, begin, end, where, which, text_begin)

    def _items(self, pairs, n):
        """The items of each text, from the distinct windows in it."""
        text, window = np.divmod(pairs, max(1, len(self.sizes)))
        count = np.diff(self.items_at)[window]
        item = self.items[np.repeat(self.items_at[:-1][window], count) + _steps(count)]
        text, item = np.divmod(np.unique(np.repeat(text, count) * max(1, len(self.ids)) + item), max(1, len(self.ids)))
        return {"items": _lists(text, pa.array(self.ids, pa.string()).take(pa.array(item)), n)}

    def _matches(self, shard, begin, end, where, which, text_begin):
        """The longest match from each hit word on, less those that only continue the one before."""
        whole = self.sizes[which] < self.window  # an item of fewer words matches as a whole
        hit = np.unique(which[~whole])
        count = np.diff(self.places_at)[hit]
        there = self.places[np.repeat(self.places_at[:-1][hit], count) + _steps(count)]
        b, e = runs(there, there + np.repeat(self.sizes[hit], count), len(self.words))
        mine, _ = gathered(begin, end)
        theirs, _ = gathered(b, e)
        if not len(mine):
            mine = theirs = np.zeros(0, np.int64)
        # a run of hit parts may pass from one item to the next: its places are cut there
        first = np.zeros(len(self.words) + 1, bool)
        first[self.at] = True
        split = np.flatnonzero((theirs >= 0) & first[theirs]) if len(theirs) else np.zeros(0, np.int64)
        theirs = np.insert(theirs, split, -1)
        words = np.concatenate((np.where(mine >= 0, shard[mine], 0), np.where(theirs >= 0, self.words[theirs], 0)))
        sought = np.arange(len(words)) >= len(mine)
        places = np.concatenate((mine, theirs))
        best, at = matching(words, places < 0, sought & (places >= 0)) if len(words) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        k = np.flatnonzero((mine >= 0) & (best[: len(mine)] >= self.window))
        p, long = np.concatenate((mine[k], where[whole])), np.concatenate((best[k], self.sizes[which[whole]]))
        q = np.concatenate((places[at[k]], self.begins[which[whole]]))
        order = np.lexsort((q, -long, p))
        order = order[np.concatenate(([True], np.diff(p[order]) > 0))] if len(p) else order
        p, long, q = p[order], long[order], q[order]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1] + 1) | (long[1:] != long[:-1] - 1)
        p, long, q = p[new], long[new], q[new]
        row = np.searchsorted(self.at, q, "right") - 1
        start = q - self.at[row]
        t = np.searchsorted(text_begin, p, "right") - 1
        ids = pa.array(self.ids, pa.string()).take(pa.array(self.item_of_row[row]))
        parts = [ids, *(pa.array(x) for x in (p - text_begin[t], start, long))]
        return {"matches": _lists(t, pa.StructArray.from_arrays(parts, ["item_id", "doc_word", "item_word", "n_words"]), len(text_begin))}


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _lists(owner: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(counts_by(owner, n), pa.int32()), values)


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in parts of about block_bytes of text; parts are dealt by a hash of the id."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    return [items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) for k in range(n)] if n > 1 else [items]


def _search(docs: DataFrame, block: DataFrame, keep: list[str], text: str, window: int):
    """find_matches() with one block, and the broadcast that it uses."""
    rows = block.collect()  # block_bytes at most, but for one longer item
    held = docs.sparkSession.sparkContext.broadcast(([r.item_id for r in rows], [r.text for r in rows]))

    def make():
        windows = Windows(*held.value, window)
        return lambda part: windows.search(part.column(text))

    return over_texts(docs, keep, f"n_words bigint, spans {SPANS}, items array<string>, matches {MATCHES}", make, text, SHARD_BYTES), held


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The kept columns with n_words, spans (hit word ranges), items and matches of each document.

    matches has, for each place from which on a document matches an item, the longest match: the item (one of those that match as
    far), the first word in the document and in the item, and the words.

    A benchmark beyond block_bytes is searched block by block: the documents are stored, each block
    is broadcast for one scan of them, which stores what it hits, and is given up before the next.
    """
    parts = blocks(benchmark, block_bytes=block_bytes)
    if len(parts) == 1:
        return _search(docs, parts[0], keep, text, window)[0]
    rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), *dict.fromkeys([*keep, text])), "decontamination")
    hits, n_words = None, None
    for block in parts:
        found, held = _search(rows, block, ["_row"], text, window)
        found = stored(found, "block-hits")
        held.unpersist()
        n_words = found.select("_row", "n_words") if n_words is None else n_words
        some = found.where("size(spans) > 0").select("_row", "spans", "items", "matches")
        hits = some if hits is None else hits.union(some)
    joined = hits.groupBy("_row").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "matches")))  # a row for each block at most
    empty = [F.coalesce(c, F.array().cast(joined.schema[c].dataType)).alias(c) for c in ("items", "matches")]
    merged = F.aggregate(F.array_sort("spans"), F.array().cast(SPANS), _add_span)
    joined = joined.withColumn("spans", merged)
    out = rows.select("_row", *keep).join(n_words, "_row").join(joined, "_row", "left")
    return out.select(*keep, "n_words", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), *empty)


def _add_span(spans, s):
    """Ascending spans, with one more that begins no earlier than the last."""
    last = F.try_element_at(spans, F.lit(-1))
    longer = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], s["end"]).alias("end"))
    joins = (F.size(spans) > 0) & (s["begin"] <= last["end"])
    return F.when(joins, F.concat(F.slice(spans, 1, F.greatest(F.lit(0), F.size(spans) - 1)), F.array(longer))).otherwise(F.concat(spans, F.array(s)))


def n_hit() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])


def contaminated() -> F.Column:
    """At least a twentieth of the words is hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """docs without the contaminated ones, in one scan and with the same columns."""
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)))
    mine = f"c{docs.columns.index(text)}"
    kept = find_matches(plain, benchmark, plain.columns, mine, window).where(~contaminated())
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
        F.aggregate("matches", F.lit(0).cast("bigint"), lambda a, m: F.greatest(a, m["n_words"])).alias("longest_match"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: By a join of all windows, for tables whose doc_id and item_id are keys.
ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (
  SELECT DISTINCT item_id, k AS start, least({WINDOW}, len(w)) AS size, array_to_string(w[k : k + least({WINDOW}, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS k FROM b WHERE len(w) > 0)),
p AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM g))),
h AS (SELECT doc_id, item_id, k, start, size FROM p JOIN g USING (size, gram)),
l AS (SELECT doc_id, max(run + size - 1) AS longest FROM (
  SELECT doc_id, size, count(*) AS run FROM (
    SELECT *, k - row_number() OVER (PARTITION BY doc_id, item_id, size, k - start ORDER BY k) AS part FROM h)
  GROUP BY doc_id, item_id, size, k - start, part) GROUP BY doc_id),
c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id) LEFT JOIN l USING (doc_id)
"""
