"""Near-duplicates by BagMinHash signatures, banding, and verified multiset overlap.

A text is the multiset of its shingles (five words; a shorter text is one shingle). Two texts
are linked if their weighted Jaccard similarity, sum of minima over sum of maxima of shingle
counts, is at least 0.8; a class is a connected component of links.

Signatures. For every shingle and every unit level of its count, a Poisson process assigns
points to registers; a register keeps its least point. Levels are grouped in a binary
hierarchy: a process over levels (0, 2**k] is split, point by point, into those of its halves, so
equal levels of a shingle give equal points in whichever text, and a point above the count is
left out. Two texts agree in a register with the probability of their similarity.

Candidates. Bands of registers are bucket keys. Within a bucket all texts are compared with
one of them (its centre), not with each other, and linked texts are joined into classes, so
copies by the thousand cost a comparison each. Buckets that still span several classes get other
centres in a few more turns, which join most of what is alike. The texts of those that are open even
then are joined across classes by prefixes: of two similar multisets, in any common order
of their shingles, the beginnings have a shingle in common, so an order by frequency, rare ones
first, gives few candidates and misses no link. This holds for buckets of every size: no link of
texts that share a band is lost.

Null texts and texts without words are classes of their own, but equal texts (null aside) are
always one class. Repeated rows are equal texts. Keys may repeat or be null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import counts_by, mix, over_texts, release, shingles, words_of
from corpusloom.session import settled, small_batches, stored, table

SHINGLE, SIMILARITY = 5, 0.8
#: Bands and registers of a band: similar texts at 0.8 share a band with probability 1 - 3e-6.
BANDS, ROWS = 32, 5
#: Further turns in which open buckets get another centre; they save comparisons later and decide nothing.
TURNS = 2
#: A shingle that begins more texts than this is dealt over several tasks.
SALTED = 1024
#: Texts of which elements are listed at once.
TEXTS_AT_ONCE = 256
#: Bytes of text that a worker hashes at once.
SLICE = 1 << 19
#: Ids are broadcast up to this many (16 MB).
BROADCAST_IDS = 2_000_000


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


def bag_signatures(hashed: np.ndarray, count: np.ndarray, owner: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures (n x registers, 64 bits) of the multisets whose distinct elements, with counts, are given by owner.

    The points of each process ascend, so all of them up to a limit are generated, the limit
    being such that few registers stay empty; texts in which one does are done again with a
    higher limit. An empty multiset has zeros.
    """
    out = np.zeros((n, registers), np.uint64)
    total = np.bincount(owner, count, n)
    limit = np.where(total > 0, (np.log(registers) + 3) / np.maximum(1, total), 0)  # in the rate of one register and level
    todo = np.flatnonzero(total > 0)
    while len(todo):
        mine = np.zeros(n, bool)
        mine[todo] = True
        use = mine[owner]
        e, c, o = hashed[use], count[use], owner[use]
        least = np.full(n * registers, np.inf)
        tags = np.zeros(n * registers, np.uint64)
        top = 0
        # blocks of levels: (0,1], (1,2], (2,4], (4,8], ...
        while len(e):
            low, high = (0, 1) if top == 0 else (1 << (top - 1), 1 << top)
            _block(mix(e + np.uint64(0x51ED270B * (top + 1))), c, o, low, high, limit, registers, least, tags)
            some = c > high
            e, c, o, top = e[some], c[some], o[some], top + 1
        least = least.reshape(n, registers)
        full = np.isfinite(least[todo]).all(1)
        done = todo[full]
        out[done] = tags.reshape(n, registers)[done]
        todo = todo[~full]
        limit[todo] *= 2
    return out


def _block(seed, count, owner, low, high, limit, registers, least, tags):
    """Add the points of the process over levels (low, high] of each element, up to limit[owner]."""
    state, at = seed, np.zeros(len(seed))
    rate = registers * (high - low)
    while len(state):
        state = mix(state + np.uint64(0x632BE59BD9B4E019))
        at = at - np.log(_uniform(state)) / rate
        live = at <= limit[owner]
        state, at, count, owner = state[live], at[live], count[live], owner[live]
        if not len(state):
            return
        draw = mix(state ^ np.uint64(0xA0761D6478BD642F))
        register = (draw % np.uint64(registers)).astype(np.int64)
        # halve the block until one level is left: the path is a property of the point
        level, width, bits = np.full(len(state), low), high - low, mix(draw)
        while width > 1:
            width //= 2
            level = level + width * (bits & np.uint64(1)).astype(np.int64)
            bits = bits >> np.uint64(1)
        inside = level < count
        where, when, tag = (owner * registers + register)[inside], at[inside], draw[inside]
        order = np.lexsort((when, where))
        where, when, tag = where[order], when[order], tag[order]
        head = np.concatenate(([True], where[1:] != where[:-1])) if len(where) else np.zeros(0, bool)
        where, when, tag = where[head], when[head], tag[head]
        better = when < least[where]
        least[where[better]], tags[where[better]] = when[better], tag[better]


def bags(column: pa.Array, width: int = SHINGLE):
    """Distinct shingle hashes, their counts, their text, and the number of texts."""
    hashed, owner, _, _, n = words_of(column)
    shingle, who = shingles(hashed, owner, n, width)
    order = np.lexsort((shingle, who))
    shingle, who = shingle[order], who[order]
    head = np.flatnonzero(np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (who[1:] != who[:-1])))) if len(who) else np.zeros(0, np.int64)
    return shingle[head], np.diff(np.append(head, len(who))), who[head], n


def banded(texts: DataFrame, keep: list[str], text: str = "text", bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """The kept columns and bands, array<bigint>: a hash of each band's registers; null for a text without words."""

    def make():
        def each(part):
            shingle, count, who, n = bags(part.column(text), width)
            made = bag_signatures(shingle, count, who, n, bands * rows).reshape(n, bands, rows)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
            for k in range(rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + made[:, :, k])
            values = pa.array(key.view(np.int64).reshape(-1))
            empty = np.bincount(who, minlength=n) == 0
            return {"bands": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), values, mask=pa.array(empty))}

        return each

    return over_texts(texts, keep, "bands array<bigint>", make, text, limit=SLICE)


def elements(texts: DataFrame, keep: list[str], text: str = "text", width: int = SHINGLE) -> DataFrame:
    """The kept columns, and elements: the multiset of shingles as a set of unsigned 64-bit hashes, ascending and packed.

    The k-th of equal shingles is an element of its own, so set overlap is multiset overlap.
    """

    def make():
        def each(part):
            shingle, count, who, n = bags(part.column(text), width)
            first = np.cumsum(count) - count
            nth = np.arange(int(count.sum())) - np.repeat(first, count)
            made = mix(np.repeat(shingle, count) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            owner = np.repeat(who, count)
            made = made[np.lexsort((made, owner))]
            at = 8 * counts_by(owner, n)
            return {"elements": pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(at), pa.py_buffer(made)]).cast(pa.binary())}

        return each

    return over_texts(texts, keep, "elements binary", make, text, limit=SLICE)


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets, given as their elements; 0 if both are empty."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    total = len(both) - same
    return same / total if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Those of the distinct pairs (a, b) of text ids whose multisets overlap enough.

    Only texts that occur in a pair are carried on: their ids are broadcast if there are no more
    than BROADCAST_IDS, and shuffled to the texts otherwise. Each gets its elements once. Both
    sides are joined by shuffles; AQE splits the partition of a frequent b.
    """
    used = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ids")
    some = texts.join(F.broadcast(used) if used.count() <= BROADCAST_IDS else used, "id", "left_semi")
    some = stored(elements(some, ["id"]), "pair-elements")
    left = pairs.join(some.select(F.col("id").alias("a"), F.col("elements").alias("of_a")), "a")
    both = left.join(some.select(F.col("id").alias("b"), F.col("elements").alias("of_b")), "b")

    def check(batches):
        for batch in batches:
            of_a, of_b = batch.column("of_a"), batch.column("of_b")
            keep = []
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(c[k].as_buffer(), np.int64) for c in (of_a, of_b))
                # sizes that differ by more than the similarity allows need no comparison
                keep.append(min(len(a), len(b)) >= similarity * max(len(a), len(b)) - 1e-6 and overlap(a, b) >= similarity)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in "ab"], ["a", "b"])
        release()

    return both.select("a", "b", "of_a", "of_b").mapInArrow(check, "a bigint, b bigint")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, root): the least id of each connected component, for the ids in links (a, b) or known (id, root).

    Alternating large-star and small-star steps (Kiveris et al., 2014): each keeps the
    connections and shortens paths; edges are pre-aggregated to minima, and no neighbourhood
    is ever collected. Each round's edges are stored, which cuts the lineage. The rounds end by
    themselves: every one brings all nodes closer to their component's least.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if known is not None:
        edges = edges.union(known.select("id", "root"))
    edges = stored(edges.where("u <> v").distinct(), "edges")
    while not _is_star_forest(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def near_classes(texts: DataFrame, sig: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, root) of the classes that verified links make, as all links that share a band would.

    texts has id and text, sig has id and bands; ids are distinct. Ids without a link may be
    absent.
    """
    sig = sig.where("bands IS NOT NULL")
    members = _shared(sig.select("id", F.explode("bands").alias("bucket")))
    pairs = stored(members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    spark = texts.sparkSession
    links = lambda some: settled(spark, "links", lambda: verified(some, texts, similarity))
    roots = settled(spark, "roots", lambda: components(links(pairs)))
    for turn in range(TURNS + 1):
        classes = stored(members.select("bucket", "id").join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("class")), "bucket-classes")
        # in a bucket of two texts, the pair has been compared; one whose texts are all in one class has nothing to add
        spread = classes.groupBy("bucket").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"), F.min_by(F.struct("id", "class"), F.xxhash64("id", "bucket", F.lit(turn))).alias("centre"))
        spread = stored(spread.where("low <> high AND n > 2").select("bucket", "centre"), "open-buckets")
        members = stored(classes.join(spread, "bucket").select("bucket", "id", "class", "centre"), "open")
        if turn == TURNS or members.isEmpty():
            break
        new = members.where(F.col("class") != F.col("centre.class")).select(F.greatest("id", "centre.id").alias("a"), F.least("id", "centre.id").alias("b"))
        new = stored(new.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
        pairs = pairs.union(new)
        found = links(new)
        if found.isEmpty():
            break
        before = roots
        roots = settled(spark, "roots", lambda found=found, before=before: components(found, before))
    some = stored(members.select("id", "class").distinct(), "open")
    if some.isEmpty():
        return roots
    new = settled(spark, "pairs", lambda: prefix_pairs(some, texts, similarity).join(pairs, ["a", "b"], "left_anti"))
    found = links(new)
    return roots if found.isEmpty() else components(found, roots)


def _packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The elements of all rows end to end, and how many each row has."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    values = np.frombuffer(column.buffers()[2], np.int64, (at[-1] - at[0]) // 8, at[0]) if at[-1] > at[0] else np.zeros(0, np.int64)
    return values, np.diff(at) // 8


def _prefixes(listed: DataFrame, similarity: float) -> DataFrame:
    """(id, element, place, size, early): the first elements of each text, rare ones first.

    A similar text of no more elements shares one of them; one of no fewer shares one of the early ones.
    The order is by the number of texts that hold the element, counted exactly, then by its hash. Elements of one text only
    come first and are left out: they are never sent back, only their number is known. So of texts that differ
    from all others in more than a fifth of their elements nothing is left, whatever the size of the data.
    """
    of_equal = 2 * similarity / (1 + similarity)

    def each(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(k, TEXTS_AT_ONCE)
                values, size = _packed(part.column("elements"))
                who = pa.array(np.repeat(np.arange(len(size)), size))
                yield pa.RecordBatch.from_arrays([part.column("id").take(who), pa.array(np.repeat(size, size), pa.int32()), pa.array(values)], ["id", "size", "element"])
        release()

    rows = listed.select("id", "elements").mapInArrow(each, "id bigint, size int, element bigint")
    often = rows.groupBy("element").agg(F.count("*").alias("texts")).where("texts > 1")
    often = stored(often, "frequencies")  # stored, so that AQE may split the rows of an element that very many texts have
    mine = Window.partitionBy("id")
    ranked = rows.join(often, "element").withColumn("nth", F.row_number().over(mine.orderBy("texts", "element"))).withColumn("others", F.count("*").over(mine))
    placed = ranked.select("id", "element", "size", (F.col("size") - F.col("others") + F.col("nth") - 1).cast("int").alias("place"))
    last, early = (F.col("size") - F.ceil(x * F.col("size") - 1e-6) for x in (similarity, of_equal))
    return placed.where(F.col("place") <= last).withColumn("early", F.col("place") <= early)


def prefix_pairs(some: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Distinct pairs (a, b) of ids in some (id, class), of different classes, among them all of at least that similarity.

    Of two similar texts in a common order of elements, the first element that they share is early in
    the smaller one and in the prefix of the other; their sizes are at most a fifth apart, so they meet by
    element and logarithm of size; and what is left of both from that element on must allow for the
    similarity. The largest class of an element is on one side only, so it isn't compared with itself;
    that side is dealt by salt, and the other is repeated for each salt.
    """
    few = some.count() <= BROADCAST_IDS // 2
    listed = stored(elements(texts.join(F.broadcast(some) if few else some, "id", "left_semi"), ["id"]), "elements")
    heads = _prefixes(listed, similarity)
    heads = stored(heads.join(F.broadcast(some) if few else some, "id"), "prefixes")
    spread = heads.groupBy("element", "class").agg(F.count("*").alias("n"), F.max("early").alias("early")).groupBy("element")
    spread = spread.agg(F.max_by("class", F.struct("n", "class")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("classes"), F.max("early").alias("early"))
    salts = F.ceil(F.col("n") / SALTED).cast("int")
    spread = stored(spread.where("classes > 1 AND early").select("element", "top", salts.alias("salts")), "spread")
    heads = heads.withColumn("scale", F.floor(F.log(F.col("size").cast("double")) / float(-np.log(similarity))).cast("int"))
    heads = stored(heads.join(spread, "element"), "prefixes")
    near = F.explode(F.array(*(F.col("scale") + k for k in (-1, 0, 1))))
    left = heads.where("class <> top").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("scale", near)
    left = left.select("element", "salt", "scale", *(F.col(c).alias(f"{c}1") for c in ("id", "class", "place", "size", "early")))
    right = heads.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    rest = F.least(F.col("size1") - F.col("place1"), F.col("size") - F.col("place"))
    allowed = (F.least("size1", "size") >= similarity * F.greatest("size1", "size") - 1e-6) & (rest * (1 + similarity) >= similarity * (F.col("size1") + F.col("size")) - 1e-6)
    smaller_early = F.when(F.col("size1") < F.col("size"), F.col("early1")).when(F.col("size1") > F.col("size"), F.col("early")).otherwise(F.col("early1") & F.col("early"))
    once = (F.col("class") == F.col("top")) | (F.col("class1") < F.col("class"))
    same = [left[c] == right[c] for c in ("element", "salt", "scale")]
    both = left.join(right, same[0] & same[1] & same[2] & once & smaller_early & allowed)
    return both.select(F.greatest("id1", "id").alias("a"), F.least("id1", "id").alias("b")).distinct()


def _shared(banded: DataFrame) -> DataFrame:
    """(id, bucket, centre) of the buckets that several ids share; the centre is the least id."""
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("centre")).where("n > 1")
    shared = stored(shared.select("bucket", "centre"), "shared")  # stored, so that AQE may split the rows of one bucket
    return stored(banded.join(shared, "bucket").select("id", "bucket", "centre"), "buckets")


def _classes(rows: DataFrame) -> DataFrame:
    """(row, root) for stored rows (row, text, bands): the least row of the class."""
    copies = rows.select("row", F.sha2("text", 256).alias("digest"))
    # equal texts become one text, whose id is its least row; only digests are shuffled
    firsts = copies.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("id"), F.count("*").alias("n")).where("n > 1")
    firsts = stored(firsts.select("digest", "id"), "firsts")  # stored, so that AQE may split the rows of one digest
    text_of = stored(copies.join(firsts, "digest", "left").select("row", F.coalesce("id", "row").alias("id")), "copies")
    sole = text_of.where("row = id").select("id")
    texts = rows.select(F.col("row").alias("id"), "text", "bands")
    sig = stored(texts.select("id", "bands").join(sole, "id", "left_semi"), "bands")
    roots = near_classes(texts.select("id", "text"), sig)
    return text_of.join(roots, "id", "left").select("row", F.coalesce("root", "id").alias("root"))


def _numbered(docs: DataFrame, text: str) -> DataFrame:
    """docs with its columns called c0, c1, ..., a row number, and the bands; stored, hence stable."""
    plain = docs.select(F.monotonically_increasing_id().alias("row"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)))
    mine = f"c{docs.columns.index(text)}"
    return stored(banded(plain, plain.columns, mine), "documents").withColumn("text", F.col(mine))


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, class_id, whether it represents its class, and the class's size.

    class_id is the least key of the class, and the representative is a document of that key;
    null keys are ignored unless the class has no other.
    """
    with small_batches(docs.sparkSession):
        rows = _numbered(docs.select(key, text), text)
        classed = settled(docs.sparkSession, "classes", lambda: rows.select("row", F.col("c0").alias("key")).join(_classes(rows), "row"))
    out = classed.join(stored(_heads(classed), "heads"), "root")  # stored, so that AQE may split a class of very many
    return out.select(F.col("key").alias(key), "class_id", (F.col("row") == F.col("head")).alias("is_representative"), "class_size")


def _heads(classed: DataFrame) -> DataFrame:
    order = F.struct(F.col("key").isNull(), "key", "row")
    return classed.groupBy("root").agg(F.min("key").alias("class_id"), F.min_by("row", order).alias("head"), F.count("*").alias("class_size"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, same columns, with one document of each class: the one of the least key."""
    with small_batches(docs.sparkSession):
        rows = _numbered(docs, text)
        keys = rows.select("row", F.col(f"c{docs.columns.index(key)}").alias("key"))
        heads = settled(docs.sparkSession, "heads", lambda: _heads(keys.join(_classes(rows), "row")).select(F.col("head").alias("row")))
    few = heads.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(heads) if few else heads, "row", "left_semi").select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
