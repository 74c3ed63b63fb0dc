"""Ranked lexical search: an impact-ordered index by term, searched in the three phases of TPUT.

A document's score for an item is the sum, over the item's terms, of the term's weight times the
term's impact in the document, in whole numbers. The index has a list for every term: the
documents that hold it, highest impact first, cut into pieces by blocks of documents (a slice of a
task's input) and partitioned by ranges of term and block, so a list of any length is spread over tasks.

The three phases (Cao and Wang, 2004), each over lists and without a loop over documents:

1. The k heads of every list are fetched. Sums of what they give a document are lower bounds of its score, the
   k-th highest of an item is the item's lower bound. So that it isn't a bound of single terms only, the documents at the heads
   whose sums are highest are looked up in all lists of the item, and the k-th highest exact score is the bound.
2. With a lower bound b and m lists, a document whose entries are all below b / m can't reach b.
   Every list sends what is at least an eighth of that, once for all items, to the documents' block, where
   sums and upper bounds (what isn't sent counts as just below the threshold) leave candidates. A threshold
   below b / m is as right, and the paper has such a factor; a list's entry is sent once for all items, so sending more costs
   little, and the upper bounds come so much closer.
3. The candidates whose upper bound reaches the k-th highest sum are looked up in all lists.

No step drops a document that could be among the k highest, and all scores returned are exact.

Items go through in groups of about GROUP_PAIRS (item, term) pairs, which are broadcast. Memory of a
task follows a block (4 MB of text or one text) and a group. The index has only terms of items while these
have no more than VOCABULARY_BYTES, and all terms beyond.

Terms are maximal runs of 0-9, a-z, A-Z and non-ASCII characters, A-Z lower-cased, compared as
strings. Null texts and texts without a term are never found; items without a term find nothing. Each row of items
is an item of its own, each row of documents a document; null keys come last among equal scores. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import folded, slices, split_words, text_bytes, word_dictionary
from corpusloom.session import stored, table

TOP = 50
#: Terms of items, up to so many bytes, are sent to the tasks that build the index.
VOCABULARY_BYTES = 32 << 20
#: (item, term) pairs that are searched at once.
GROUP_PAIRS = 1 << 20
#: Sums of a block that are held at once.
CELLS = 1 << 22
#: Documents that are looked up for the lower bound of phase 1, as a multiple of those wanted.
PROBED = 4
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The threshold of phase 2 is the lower bound by the number of lists and by this.
TIGHTER = 8
#: Impacts are whole numbers up to this.
HIGHEST = 1_000_000


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of each item."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(TERM), 0)
    return items.select(F.col(item).alias("item"), F.explode(F.array_distinct(found)).alias("term"))


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """How many documents have a term, and how many terms all have, with repeats."""

    def count(batches):
        with_terms = total = 0
        for part in slices(batches, text):
            data, at = text_bytes(part.column(text))
            n = np.diff(split_words(folded(data) > 0, at)[2])
            with_terms, total = with_terms + int(np.count_nonzero(n)), total + int(n.sum())
        yield pa.RecordBatch.from_pydict({"docs": pa.array([with_terms], pa.int64()), "terms": pa.array([total], pa.int64())})

    row = docs.select(text).mapInArrow(count, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Impact of a term that occurs tf times in a document of n terms, in whole numbers as the scoring formula has them."""
    length = 50 + (50 * n * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * length)


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Pieces of values, packed, between the offsets."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at * values.itemsize)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _unpacked(column: pa.ChunkedArray | pa.Array, kind=np.int32) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a packed column end to end, and the offsets of the rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    width = np.dtype(kind).itemsize
    values = np.frombuffer(column.buffers()[2], kind, (at[-1] - at[0]) // width, at[0]) if at[-1] > at[0] else np.zeros(0, kind)
    return values, (at - at[0]) // width


INDEX = "term string, block bigint, places binary, impacts binary, keys binary"


def build_index(docs: DataFrame, size: tuple[int, int], vocabulary: pa.Array | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, stored and in order of term and block: (term, block, places, impacts), and for each block a row of no term with its keys.

    places are the documents' positions in their block, in order of impact; both are packed 32-bit numbers. keys are
    packed 64-bit numbers after as many bytes that tell which are null.
    """
    terms_of = docs.sparkSession.sparkContext.broadcast(vocabulary) if vocabulary is not None else None

    def build(batches):
        block = TaskContext.get().partitionId() << 33
        for part in slices(batches, text):
            data, at = text_bytes(part.column(text))
            lower = folded(data)
            begin, end, words_at = split_words(lower > 0, at)
            n, count = np.diff(words_at), part.num_rows
            words = word_dictionary(lower, begin, end)
            names, number = words.dictionary, words.indices.to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(count), n)
            if terms_of is not None:
                wanted = pc.is_in(names, value_set=terms_of.value).to_numpy(zero_copy_only=False)[number]
                number, owner = number[wanted], owner[wanted]
            pairs, tf = np.unique(number * count + owner, return_counts=True)
            number, owner = np.divmod(pairs, count)
            impact = impacts(tf, n[owner], *size)
            by = np.lexsort((owner, -impact, number))
            number, owner, impact = number[by], owner[by], impact[by]
            heads = np.flatnonzero(np.diff(number, prepend=-1))
            rows_at = np.append(heads, len(number))
            keys = part.column(key).cast(pa.int64())
            packed = pc.is_null(keys).to_numpy(zero_copy_only=False).tobytes() + pc.fill_null(keys, 0).to_numpy().astype("<i8").tobytes()
            listed = names.take(pa.array(number[heads])).cast(pa.string())
            some = len(heads)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([listed, pa.nulls(1, pa.string())]), pa.array(np.full(some + 1, block)),
                    pa.concat_arrays([_binary(owner.astype(np.int32), rows_at), pa.nulls(1, pa.binary())]),
                    pa.concat_arrays([_binary(impact.astype(np.int32), rows_at), pa.nulls(1, pa.binary())]),
                    pa.concat_arrays([pa.nulls(some, pa.binary()), pa.array([packed], pa.binary())]),
                ],
                ["term", "block", "places", "impacts", "keys"],
            )
            block += 1

    made = stored(docs.select(key, text).mapInArrow(build, INDEX), "index-by-block")
    return stored(made.repartitionByRange("term", "block").sortWithinPartitions("term", "block"), "index")


def _vocabulary(pairs: DataFrame) -> pa.Array | None:
    """The terms of items, or None if they have too many bytes."""
    terms = pairs.select("term").distinct()
    if (terms.agg(F.sum(F.octet_length("term"))).first()[0] or 0) > VOCABULARY_BYTES:
        return None
    return terms.toArrow().column("term").combine_chunks().cast(pa.large_string())


def weights(pairs: DataFrame, index: DataFrame, docs: int) -> DataFrame:
    """(item, term, weight, lists) of the terms that weigh anything; lists is how many of them the item has."""
    df = index.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.octet_length("places") / 4).cast("bigint").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighed = pairs.join(df, "term").select("item", "term", weight.alias("weight")).where("weight > 0")
    return weighed.join(weighed.groupBy("item").agg(F.count("*").alias("lists")), "item")


def _kth(sums: DataFrame, score: str, top: int) -> DataFrame:
    """(item, bound): the top-th highest score of each item that has so many."""
    order = Window.partitionBy("item").orderBy(F.desc(score), "block", "place")
    return sums.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top).where(F.col("n") == top).select("item", F.col(score).alias("bound"))


def _heads(index: DataFrame, top: int) -> DataFrame:
    """(term, block, place, impact): the entries of highest impact of every list."""

    def first(batches):
        for batch in batches:
            place, at = _unpacked(batch.column("places"))
            impact, _ = _unpacked(batch.column("impacts"))
            row = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(at)))
            yield pa.RecordBatch.from_arrays([batch.column("term").take(row), batch.column("block").take(row), pa.array(place), pa.array(impact)], ["term", "block", "place", "impact"])

    cut = index.where("term IS NOT NULL").select("term", "block", *(F.substring(c, 1, 4 * top).alias(c) for c in ("places", "impacts")))
    rows = cut.mapInArrow(first, "term string, block bigint, place int, impact int")
    order = Window.partitionBy("term").orderBy(F.desc("impact"), "block", "place")
    return rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= top).drop("n")


class _Group:
    """The (item, term) pairs of a group of items in order of item, with a threshold of impact each."""

    def __init__(self, pairs: pa.Table):
        pairs = pairs.combine_chunks()
        number = lambda c: pairs.column(c).to_numpy()
        order = np.argsort(number("item"), kind="stable")
        self.items, self.at = np.unique(number("item")[order], return_index=True)
        self.at = np.append(self.at, len(order))
        terms = pairs.column("term").combine_chunks().cast(pa.large_string()).take(pa.array(order)).dictionary_encode()
        self.terms, self.term = terms.dictionary, terms.indices.to_numpy().astype(np.int64)
        self.weight, self.bound = number("weight")[order], number("bound")[order]
        # an entry is sent if weight * impact * lists * TIGHTER >= bound
        each = self.weight * number("lists")[order] * TIGHTER
        self.least = (self.bound + each - 1) // each


def _block_sums(group: _Group, lists: pa.Table, complete: bool, only: np.ndarray | None = None):
    """Sums of a block's documents for the items of a group, some items at a time: (items, sums, upper bounds), each items x documents.

    complete: all entries count, else those that reach the pair's threshold. Sums are below 2**53, so doubles hold them exactly.
    """
    lists = lists.filter(pc.is_in(lists.column("term").cast(pa.large_string()), value_set=group.terms)).combine_chunks()
    named = pc.index_in(lists.column("term").cast(pa.large_string()), value_set=group.terms)
    number = named.to_numpy().astype(np.int64)
    place, at = _unpacked(lists.column("places"))
    impact, _ = _unpacked(lists.column("impacts"))
    if not len(place):
        return
    row = np.repeat(np.arange(len(number)), np.diff(at))
    if only is not None:
        keep = np.isin(place, only)
        place, impact, row = place[keep], impact[keep], row[keep]
        at = np.searchsorted(row, np.arange(len(number) + 1))
    docs = int(place.max()) + 1 if len(place) else 0
    # where each pair's list is, and up to where its entries reach the pair's threshold
    list_of = np.full(len(group.terms), -1)
    list_of[number] = np.arange(len(number))
    mine = list_of[group.term]
    key = row * (2 * HIGHEST) + HIGHEST - impact
    least = np.zeros(len(mine), np.int64) if complete else np.minimum(group.least, HIGHEST + 1)
    stop = np.where(mine >= 0, np.searchsorted(key, mine * (2 * HIGHEST) + HIGHEST - least, "right"), 0)
    start = np.where(mine >= 0, at[mine], 0)
    size = np.maximum(0, stop - start)
    missed = group.weight * np.maximum(0, least - 1)
    step = max(1, CELLS // max(1, docs))
    for k in range(0, len(group.items), step):
        of = np.arange(k, min(k + step, len(group.items)))
        a, b = group.at[of[0]], group.at[of[-1] + 1]
        item = np.repeat(np.arange(len(of)), np.diff(group.at[of[0] : of[-1] + 2]))
        rest = np.bincount(item, missed[a:b], len(of))
        entry = np.repeat(np.arange(a, b), size[a:b])
        read = np.repeat(start[a:b] - np.cumsum(size[a:b]) + size[a:b], size[a:b]) + np.arange(len(entry))
        cell = item[entry - a] * docs + place[read]
        given = group.weight[entry] * impact[read].astype(np.int64)
        sums = np.bincount(cell, given, len(of) * docs).reshape(len(of), docs)
        upper = sums + rest[:, None] - np.bincount(cell, missed[entry], len(of) * docs).reshape(len(of), docs)
        yield of, sums, upper


SUMS = "item bigint, block bigint, place int, score bigint, upper bigint"


def _sent(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of each list what reaches the least of its items' thresholds."""
    each = F.col("weight") * F.col("lists") * TIGHTER
    least = pairs.groupBy("term").agg(F.min(F.floor((F.col("bound") + each - 1) / each)).cast("bigint").alias("least"))

    def cut(batches):
        for batch in batches:
            impact, at = _unpacked(batch.column("impacts"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            reaches = impact >= batch.column("least").to_numpy()[row]
            place, _ = _unpacked(batch.column("places"))
            left = np.concatenate(([0], np.cumsum(np.bincount(row[reaches], minlength=batch.num_rows)))).astype(np.int64)
            made = pa.RecordBatch.from_arrays([batch.column("term"), batch.column("block"), _binary(place[reaches], left), _binary(impact[reaches], left)], ["term", "block", "places", "impacts"])
            yield made.filter(pa.array(np.diff(left) > 0))

    return index.join(least, "term").select("term", "block", "places", "impacts", "least").mapInArrow(cut, "term string, block bigint, places binary, impacts binary")


def _candidates(lists: DataFrame, group, top: int) -> DataFrame:
    """SUMS of the documents of each block that may be among the top of an item, as far as the block can tell."""

    def sum_up(lists: pa.Table) -> pa.Table:
        out = []
        for of, sums, upper in _block_sums(group.value, lists, False):
            bar = np.maximum(group.value.bound[group.value.at[of]], 1).astype(np.float64)
            if sums.shape[1] >= top:
                bar = np.maximum(bar, np.partition(sums, -top, 1)[:, -top])
            i, place = np.nonzero((upper >= bar[:, None]) & (sums > 0))
            out.append(_sums(group.value.items[of[i]], lists.column("block")[0].as_py(), place, sums[i, place], upper[i, place]))
        return pa.concat_tables(out) if out else _sums()

    return lists.groupBy("block").applyInArrow(sum_up, SUMS)


def _sums(items=(), block: int = 0, place=(), score=(), upper=()) -> pa.Table:
    n = len(items)
    columns = {"item": pa.array(items, pa.int64()), "block": pa.array(np.full(n, block), pa.int64()), "place": pa.array(place, pa.int32())}
    return pa.table(columns | {"score": pa.array(np.asarray(score, np.int64)), "upper": pa.array(np.asarray(upper, np.int64))})


def _looked_up(candidates: DataFrame, index: DataFrame, group) -> DataFrame:
    """(item, block, place, key, score): the exact scores of candidates (item, block, place), each looked up in all lists of its item."""

    def look(wanted: pa.Table, lists: pa.Table) -> pa.Table:
        items, place = wanted.column("item").to_numpy(), wanted.column("place").to_numpy()
        score = np.zeros(len(items), np.int64)
        mine = np.searchsorted(group.value.items, items)
        keys = lists.filter(pc.is_valid(lists.column("keys"))).column("keys")
        if len(items) and len(keys):
            for of, sums, _ in _block_sums(group.value, lists.filter(pc.is_valid(lists.column("term"))), True, np.unique(place)):
                some = np.flatnonzero((mine >= of[0]) & (mine <= of[-1]) & (place < sums.shape[1]))
                score[some] = sums[mine[some] - of[0], place[some]].astype(np.int64)
            packed = keys[0].as_py()
            n = len(packed) // 9
            key = pa.array(np.frombuffer(packed, "<i8", n, n)[place], mask=np.frombuffer(packed, bool, n)[place])
        else:
            key = pa.nulls(len(items), pa.int64())
        return pa.table({"item": wanted.column("item"), "block": wanted.column("block"), "place": wanted.column("place"), "key": key, "score": pa.array(score)})

    schema = "item bigint, block bigint, place int, key bigint, score bigint"
    return candidates.select("item", "block", "place").groupBy("block").cogroup(index.groupBy("block")).applyInArrow(look, schema)


def _search_group(pairs: DataFrame, index: DataFrame, top: int) -> DataFrame:
    """(item, block, place, key, score) of what may be among the top of the items of pairs (item, term, weight, lists), exact and all of it."""
    sc = pairs.sparkSession.sparkContext
    listed = index.join(pairs.select("term").distinct(), "term", "left_semi")
    heads = stored(_heads(listed, top), "heads")
    sums = heads.join(pairs, "term").groupBy("item", "block", "place").agg(F.sum(F.col("weight") * F.col("impact")).alias("score"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "block", "place")
    probes = stored(sums.withColumn("n", F.row_number().over(best)).where(F.col("n") <= PROBED * top).drop("n"), "probes")
    unbounded = pairs.withColumn("bound", F.lit(0).cast("bigint"))
    group = sc.broadcast(_Group(unbounded.toArrow()))
    exact = _looked_up(probes, index, group)
    bounds = stored(_kth(exact, "score", top), "bounds")
    bounded = stored(pairs.join(bounds, "item", "left").withColumn("bound", F.coalesce("bound", F.lit(0))), "bounded")
    group = sc.broadcast(_Group(bounded.toArrow()))
    found = stored(_candidates(_sent(index, bounded), group, top), "candidates")
    better = _kth(found, "score", top)
    left = found.join(better, "item", "left").where(F.col("upper") >= F.coalesce("bound", F.lit(0)))
    return _looked_up(left, index, group)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """The columns of items with rank, key and score of the top documents of each item, by falling score, then rising key."""
    if clash := {"rank", "score", key} & set(items.columns):
        raise ValueError(f"columns of the items have names of results: {sorted(clash)}")
    numbered = stored(items.select(F.monotonically_increasing_id().alias("_item"), *(F.col(f"`{c}`") for c in items.columns)), "items")
    pairs = stored(item_terms(numbered, "_item", f"`{item_text}`"), "item-terms")
    size = corpus_size(docs, text)
    if not size[0]:
        return numbered.where("false").select(*items.columns, F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias(key), F.lit(0).cast("bigint").alias("score"))
    index = build_index(docs, size, _vocabulary(pairs), key, text)
    weighed = stored(weights(pairs, index, size[0]), "weights")
    groups = -(-max(1, weighed.count()) // GROUP_PAIRS)
    found = None
    for k in range(groups):
        some = weighed.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == k)
        part = stored(_search_group(some, index, top), "found")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"), "block", "place")
    ranked = found.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.select(F.col("item").alias("_of"), F.col("rank").alias("_rank"), F.col("key").alias("_key"), F.col("score").alias("_score"))
    both = ranked.join(numbered, F.col("_of") == F.col("_item"))
    return both.select(*(F.col(f"`{c}`") for c in items.columns), F.col("_rank").alias("rank"), F.col("_key").alias(key), F.col("_score").alias("score"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return search(table(spark, sf_dir, "documents"), items).select("item_id", "rank", "doc_id", "score")


ORACLE = f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
size AS (SELECT doc_id, count(*) AS terms FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS all_docs, CAST(sum(terms) AS BIGINT) AS all_terms FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT item_id, term, CAST(floor(1000 * ln(CAST(2 * all_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS weight FROM q JOIN df USING (term), total),
s AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * terms * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM w JOIN tf USING (term) JOIN size USING (doc_id), total GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP}
"""
