import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm import langid as L


def test_query_on_held_out(spark):
    d = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    rows = L.op1_language_id(spark, d).collect()
    assert {r.doc_id for r in rows} == set(lang)
    held = [r for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.3
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def brute_grams(text):
    """n-grams of lower-cased letters with one gap for what lies between words; no gap inside."""
    out, line, gap = [], [], False
    for k, c in enumerate(text):
        if c.isalpha():
            low = c.lower()
            line.append(low if len(low) == 1 else c)
            gap = False
        elif not gap or k == 0:
            line.append(" ")
            gap = True
    for n in L.ORDERS:
        for k in range(len(line) - n + 1):
            g = line[k : k + n]
            if " " not in g[1:-1] and not (n == 1 and g == [" "]):
                out.append("".join(g))
    return out


def test_grams_are_those_of_the_definition():
    for text in ("Straße, 12 ÉTÉ!", "a", " x  y ", "", "日本 語", "..."):
        bucket, who, letter = L.grams(pa.array([text]))
        want = brute_grams(text)
        assert len(bucket) == len(want) and letter[0] == any(c.isalpha() for c in text)
        again, _, _ = L.grams(pa.array([" ".join(want)]))  # equal grams fall into equal buckets
        assert set(bucket.tolist()) <= set(again.tolist())
        assert sorted(bucket.tolist()) == sorted(brute_bucket(g) for g in want)


def brute_bucket(gram):
    """The hash by plain integers: a polynomial of the code points, and the finaliser of splitmix64."""
    m = (1 << 64) - 1
    x = 0
    for c in gram:
        x = x * 0x100000001B3 + ord(c) & m
    x = x + len(gram) & m
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ x >> 27) * 0x94D049BB133111EB & m
    return (x ^ x >> 31) % L.BUCKETS


def test_model_and_scores_equal_brute_force(spark):
    import math
    from collections import Counter

    rows = [(1, "hello there world", "en"), (2, "the other words", "en"), (3, "bonjour le monde", "fr"), (4, "été là-bas", "fr"), (5, "der Straße nach", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {x: Counter(brute_bucket(g) for _, t, lang in rows if lang == x for g in brute_grams(t)) for x in ("de", "en", "fr")}
    seen = ["the world", "le monde été", "Straße", "zzz qqq", "hello " * 40]
    got = L.identify(spark.createDataFrame(list(enumerate(seen)), "k long, text string"), L.train(df), ["k"]).orderBy("k").collect()
    for t, r in zip(seen, got):
        grams = [brute_bucket(g) for g in brute_grams(t)]
        logs = {x: sum(math.log((n[b] + L.SMOOTHING) / (n.total() + L.SMOOTHING * L.BUCKETS)) for b in grams) * min(1, L.EVIDENCE / len(grams)) for x, n in counts.items()}
        best = max(logs, key=logs.get)
        assert abs(r.score - 1 / sum(math.exp(v - logs[best]) for v in logs.values())) < 1e-4
        assert r.lang_pred == best or abs(r.score - 1 / 3) < 1e-3


def test_texts_do_not_mix():
    both, who, _ = L.grams(pa.array(["abc", None, "", "dé f"]))
    alone = [L.grams(pa.array([t]))[0].tolist() for t in ("abc", None, "", "dé f")]
    assert [sorted(both[who == k].tolist()) for k in range(4)] == [sorted(x) for x in alone]


def test_edges(spark):
    rows = [(1, "hello there world", "en", 0.5), (2, "bonjour le monde", "fr", 0.5), (3, None, "fr", 0.5), (4, "", None, 0.5), (5, "1234 !?", "en", 0.5), (None, "hello", None, 0.5), (7, "le monde " * 20_000, None, 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra double")
    got = L.identify(df, L.train(df), ["doc_id"]).collect()
    assert [r.lang_pred for r in got] == ["en", "fr", "und", "und", "und", "en", "fr"]
    assert [r.score for r in got][2:5] == [0, 0, 0]
    nothing = L.train(df.where("lang = 'xx'"))
    assert {r.lang_pred for r in L.identify(df, nothing, ["doc_id"]).collect()} == {"und"}
    assert L.identify(df.where("false"), L.train(df), ["doc_id"]).count() == 0
    kept = L.keep_identified(spark, df, "")
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 7}
    odd = df.withColumnsRenamed({"extra": "a.b"}).withColumn("_lang", F.lit(1)).withColumn("score", F.lit("s"))  # names of results, and one with a dot
    assert L.keep_identified(spark, odd, "").columns == odd.columns and L.keep_identified(spark, odd, "").count() == 4


def test_label_is_no_input(spark):
    df = spark.createDataFrame([(1, "hello there", "en"), (2, "bonjour monde", "fr")], "doc_id long, text string, lang string")
    model = L.train(df)
    swapped = df.selectExpr("doc_id", "text", "'zz' AS lang")
    assert [r.lang_pred for r in L.identify(swapped, model, ["doc_id"]).collect()] == ["en", "fr"]


def test_many_languages_in_turns(spark, monkeypatch):
    """More languages than are scored at once give what one matrix of all gives; also where several turns are needed."""
    rng = np.random.default_rng(1)
    rows = [(k, " ".join("".join(rng.choice(list(f"abcdefgh{chr(0x430 + k % 30)}"), 6)) for _ in range(8)), f"l{k % 60:03}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df)
    assert len(model.languages) == 60
    monkeypatch.setattr(L, "LANGUAGES_AT_ONCE", 17)
    some = spark.createDataFrame([(k, t) for k, t, _ in rows[::9]] + [(-1, ""), (-2, None)], "doc_id long, text string")
    turns = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(some, model, ["doc_id"]).collect()}
    monkeypatch.setattr(L, "LANGUAGES_AT_ONCE", 1000)
    once = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(some, model, ["doc_id"]).collect()}
    assert turns[-1] == turns[-2] == ("und", 0.0) and {k: v[0] for k, v in turns.items()} == {k: v[0] for k, v in once.items()}
    assert all(abs(turns[k][1] - once[k][1]) < 1e-9 for k in once)
