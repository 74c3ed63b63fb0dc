import hashlib
import re

import numpy as np
import pyarrow as pa

from corpusloom.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)) if text else []


def brute(docs, items):
    windows = {}
    for i, t in items:
        if i is None or t is None:
            continue
        w = split(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    out = {}
    for key, t in docs:
        w, hit, found = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[k : k + size])):
                    found |= ids
                    hit |= set(range(k, k + size))
        out[key] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def longest(docs, items):
    """{key: [(doc_word, longest match from there on)]}, less those that only continue the one before."""
    texts = [split(t) for i, t in items if i is not None and t]
    out = {}
    for key, t in docs:
        w, best = split(t), {}
        for x in texts:
            run = [[0] * (len(x) + 1) for _ in range(len(w) + 1)]
            for a in range(len(w) - 1, -1, -1):
                for b in range(len(x) - 1, -1, -1):
                    if w[a] == x[b]:
                        run[a][b] = 1 + run[a + 1][b + 1]
                        if run[a][b] >= 13 or b == 0 and run[a][b] == len(x):
                            best[a] = max(best.get(a, 0), run[a][b])
        out[key] = [(a, n) for a, n in sorted(best.items()) if best.get(a - 1) != n + 1]
    return out


def digest(rows):
    from pyspark.sql import functions as F

    rows = rows.select("doc_id", "n_words", D.n_hit().alias("h"), F.size("items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256), D.contaminated())
    return {r[0]: tuple(r[1:]) for r in rows.collect()}


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = D.op7_decontamination(spark, d).collect()
    got = {r[0]: tuple(r[1:6]) for r in rows}
    assert got == brute(docs, items)
    assert {r.doc_id: r.longest_match for r in rows if r.n_hit} == {k: max(n for _, n in v) for k, v in longest([x for x in docs if got[x[0]][1]], items).items()}
    assert any(v[4] for v in got.values())


def cases():
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(rng.choice(["a", "b", "ü", "c9"], n))
    items = [(1, word(13)), (2, word(30)), (3, "A b"), (4, "--"), (5, None), (None, "a a a"), (6, "c9 " * 20), (1, "a b"), (7, "zz qq"), (7, "zz qq")]
    docs = [(k, word(int(rng.integers(0, 400)))) for k in range(30)]
    docs += [(40, None), (41, ""), (42, "!!"), (43, items[0][1]), (44, "x " * 500 + items[1][1]), (45, "c9 " * 3000), (46, "zz"), (47, "ZZ... qq"), (48, items[1][1][:50] + "zz"), (48, "a b")]
    return docs, items


def test_edge_cases_and_blocks(spark):
    docs, items = cases()
    docs = docs[:-1]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert digest(D.find_matches(df, bench, ["doc_id"])) == want
    assert digest(D.find_matches(df, bench, ["doc_id"], block_bytes=40)) == want
    assert digest(D.find_matches(df.where("false"), bench, ["doc_id"])) == {}
    assert all(v[1] == 0 for v in digest(D.find_matches(df, bench.where("false"), ["doc_id"])).values())


def test_matches_are_maximal(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, "x y " + text + " z"), (2, " ".join(f"w{k}" for k in range(5, 25)))], "doc_id long, text string")
    bench = spark.createDataFrame([("i", text)], "item_id string, text string")
    got = {r.doc_id: [tuple(m) for m in r.matches] for r in D.find_matches(docs, bench, ["doc_id"]).collect()}
    assert got == {1: [("i", 2, 0, 40)], 2: [("i", 0, 5, 20)]}


def test_longest_matches_equal_brute_force(spark):
    docs, items = cases()
    docs = docs[:-1]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want, words, texts = longest(docs, items), {k: split(t) for k, t in docs}, {}
    for i, t in items:
        texts.setdefault(str(i), []).append(split(t))
    found = {r.doc_id: r.matches for r in D.find_matches(df, bench, ["doc_id"]).collect()}
    for key, matches in found.items():
        # a text of one shared short item may also continue a longer match; brute force then has the same places
        assert {(m.doc_word, m.n_words) for m in matches if m.n_words >= 13} == {x for x in want[key] if x[1] >= 13}, key
        for m in matches:  # where it says that it is
            assert any(x[m.item_word : m.item_word + m.n_words] == words[key][m.doc_word : m.doc_word + m.n_words] for x in texts[m.item_id])
    blocks = D.find_matches(df, bench, ["doc_id"], block_bytes=40).collect()
    assert {r.doc_id: max((m.n_words for m in r.matches), default=0) for r in blocks} == {k: max((m.n_words for m in v), default=0) for k, v in found.items()}


def test_one_word_repeated_on_both_sides():
    import resource
    import time

    began, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    windows = D.Windows(["i"], ["a " * 200_000])
    found = windows.search(pa.array(["a " * 200_000, "b " + "a " * 20]))
    assert found["spans"].to_pylist() == [[{"begin": 0, "end": 200_000}], [{"begin": 1, "end": 21}]]
    assert [x[0]["n_words"] for x in found["matches"].to_pylist()] == [200_000, 20] and found["items"].to_pylist() == [["i"], ["i"]]
    assert time.time() - began < 60 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000  # KB; all pairs of places are 4e10


def test_decontaminate_keeps_columns(spark):
    docs = spark.createDataFrame([("t", 1, "a b"), ("u", 2, "clean words")], "items string, n_words long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = D.decontaminate(docs, bench)
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.collect()] == [("u", 2, "clean words")]


def test_suffix_array_sorts_to_depth():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 3000):
        for letters in (1, 2, 50):
            x = rng.integers(1, letters + 1, n).astype(np.uint64)
            order = D.suffix_array(x, 13)
            keys = [tuple(x[p : p + 13]) for p in order]
            assert sorted(order) == list(range(n)) and keys == sorted(keys)
