from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import neardup as N
from tests.llm.test_decontamination import split


def bag(text):
    w = split(text)
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute(docs):
    """{key: least key of its class} by comparing all texts that share a shingle."""
    bags = {k: bag(t) for k, t in docs}
    text = dict(docs)
    root = {k: k for k in text}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        root[b] = a

    first, owners = {}, defaultdict(list)
    for k, t in docs:
        if t is not None:
            join(k, first.setdefault(t, k))
            if first[t] == k:
                for s in bags[k]:
                    owners[s].append(k)
    pairs = {(a, b) for ks in owners.values() for i, a in enumerate(ks) for b in ks[:i]}
    for a, b in pairs:
        both = (bags[a] & bags[b]).total()
        if both >= 0.8 * (bags[a] | bags[b]).total():
            join(a, b)
    return {k: find(k) for k in text}


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in N.op6_near_duplicates(spark, d).collect()}
    assert got == brute(docs)
    assert len(set(got.values())) < len(got)


def cases():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(500)]
    base = [list(rng.choice(vocabulary, 120)) for _ in range(3)]
    docs = [(0, None), (1, None), (2, ""), (3, ""), (4, "!!!"), (5, "??"), (6, "one two"), (7, "ONE, two"), (8, "one two three")]
    for k in range(10, 90):  # near copies: each differs from the base by a word or two
        w = list(base[k % 3])
        for at in rng.integers(0, 120, 2):
            w[at] = "x" + str(k)
        docs.append((k, " ".join(w)))
    docs += [(k, docs[20][1]) for k in range(90, 120)]  # exact copies
    passage = " ".join(rng.choice(vocabulary, 40))
    docs += [(k, passage + " " + " ".join(rng.choice(vocabulary, 40))) for k in range(120, 180)]  # a common passage, but not copies
    docs += [(180, "again " * 3000), (181, "again " * 2950), (182, "again " * 1000)]
    return docs


def test_groups_passages_and_edges(spark):
    docs = cases()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert want[7] == 6 and want[8] == 8 and want[3] == 2 and want[1] == 1 and want[181] == 180 and want[182] == 182
    assert {r.doc_id: r.class_id for r in N.near_duplicate_classes(df).collect()} == want


def test_links_within_large_buckets(spark):
    # a common passage puts all texts into large buckets; pairs are at or just below 0.8, others below
    rng = np.random.default_rng(7)
    passage = " ".join(f"p{k}" for k in range(200))
    docs, sides = [], []
    for k in range(150):
        m = int(rng.integers(1, 5))
        u = 26 - m - int(rng.integers(0, 2))
        shared = "".join(f" s{k}.{j}".replace(".", "x") for j in range(m))
        pair = [passage + shared + "".join(f" u{k}x{side}x{j}" for j in range(u)) for side in range(2)]
        a, b = map(bag, pair)
        sides.append((a & b).total() / (a | b).total())
        docs += [(2 * k + side, t) for side, t in enumerate(pair)]
    tail = [f"c{j}" for j in range(26)]
    for k in range(300, 340):  # a class within the same buckets
        docs.append((k, passage + " " + " ".join(tail[:-1] + [f"d{k}"])))
    order = rng.permutation(len(docs))
    docs = [docs[k] for k in order]
    want = brute(docs)
    assert min(sides) < 0.8 <= max(sides) and len(set(want.values())) > 150
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in N.near_duplicate_classes(df).collect()} == want


def template_corpus(pairs=500):
    """Texts of one long template, all alike at 0.786, and with one other each at 0.807."""
    template = [f"t{j}" for j in range(410)]
    docs = []
    for k in range(pairs):
        for side in range(2):
            w = list(template)
            for j in range(8):  # each word that is replaced changes five shingles
                w[20 + 40 * j] = f"own{k}" if j < 1 else f"own{k}x{side}" if j < 8 else w[20 + 40 * j]
            docs.append((2 * k + side, " ".join(w) + " " + " ".join(f"e{k}x{i}" if i > 3 else f"e{k}x{side}x{i}" for i in range(8))))
    return docs


def test_template_corpus_loses_no_link(spark):
    docs = template_corpus()
    bags = [bag(t) for _, t in docs[:6]]
    alike = lambda a, b: (bags[a] & bags[b]).total() / (bags[a] | bags[b]).total()
    assert 0.75 < alike(0, 2) < 0.8 <= alike(0, 1) < 0.85, (alike(0, 2), alike(0, 1))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.class_id for r in N.near_duplicate_classes(df).collect()}
    assert got == {k: k - k % 2 for k, _ in docs}


def test_prefix_pairs_miss_no_similar_pair(spark):
    rng = np.random.default_rng(3)
    docs = []
    for k in range(120):  # lengths differ, so that both sides of a pair may be the smaller
        w = [f"b{j}" for j in range(int(rng.integers(60, 90)))]
        for at in rng.integers(0, len(w), int(rng.integers(0, 3))):
            w[at] = f"x{int(rng.integers(0, 40))}"
        docs.append((k, " ".join(w)))
    df = spark.createDataFrame(docs, "id long, text string")
    got = {(r.a, r.b) for r in N.prefix_pairs(df.select("id", (F.col("id") % 50).alias("class")), df).collect()}
    bags = dict((k, bag(t)) for k, t in docs)
    want = {(a, b) for a in bags for b in range(a) if a % 50 != b % 50 and (bags[a] & bags[b]).total() >= 0.8 * (bags[a] | bags[b]).total()}
    assert len(want) > 100 and want <= got


def near_misses(templates, each):
    """Families of texts that are all alike at 0.793: the same nine words of 394 are every text's own."""
    return [(f * each + k, " ".join(f"f{f}k{k}w{j}" if j % 43 == 5 and j < 390 else f"f{f}w{j}" for j in range(394))) for f in range(templates) for k in range(each)]


@pytest.mark.parametrize("templates", [40, 400])
def test_near_misses_are_no_candidates(spark, templates):
    """However many families there are, at most 1 % of a family's pairs are compared (with frequencies in a table of fixed size, all were in the end)."""
    docs = near_misses(templates, 50)
    bags = [bag(t) for _, t in docs[:50]]
    assert all(0.79 < (a & b).total() / (a | b).total() < 0.8 for i, a in enumerate(bags) for b in bags[:i])
    df = spark.createDataFrame(docs, "id long, text string").repartition(8)
    pairs = N.prefix_pairs(df.select("id", F.col("id").alias("class")), df).count()
    assert pairs <= 0.01 * templates * 50 * 49 / 2


def test_deduplicate(spark):
    rows = [(2, "a b", "x", 0), (1, "a b", "y", 1), (None, "a b", "z", 2), (5, None, "n", 3), (5, None, "n", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bands string, row long")
    got = N.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, "a b", "y", 1), (5, None, "n", 3), (5, None, "n", 3)]
    assert N.near_duplicate_classes(df.where("false")).count() == 0


def test_signatures_are_unbiased_and_consistent():
    rng = np.random.default_rng(0)
    a = {k: int(rng.integers(1, 40)) for k in range(60)}
    b = {k: (a[k] if k % 3 else int(rng.integers(1, 90))) for k in range(10, 60)} | {k: 2 for k in range(100, 110)}
    keys = set(a) | set(b)
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)

    def sign(*bags):
        h = N.mix(np.array([k for d in bags for k in d], np.uint64))
        c = np.array([v for d in bags for v in d.values()])
        return N.bag_signatures(h, c, np.repeat(np.arange(len(bags)), [len(d) for d in bags]), len(bags), 20_000)

    both = sign(a, b)
    assert (both[0] == sign(a)[0]).all()
    assert abs((both[0] == both[1]).mean() - true) < 0.015


def test_overlap_counts_multiplicity(spark):
    def made(*texts):
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string")
        return [np.frombuffer(r.elements, np.uint64) for r in N.elements(df, ["id"], width=1).orderBy("id").collect()]

    a, b, none, null = made("a a b", "b a b", "", None)
    assert (np.diff(a) > 0).all() and N.overlap(a, b) == 0.5 and N.overlap(a, a) == 1.0 and N.overlap(none, null) == 0.0
    shingle, count, who, n = N.bags(pa.array(["a a a a a a a", None, "b"]))
    assert n == 3 and sorted(count.tolist()) == [1, 3] and who.tolist() == [0, 2]
