import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import calibration, quality, toxicity


def held_out_accuracy(spark, rows, label):
    truth = {r.doc_id: r[label] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(truth[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in truth]
    assert all(0 <= s <= 1 and p == (s >= 0.3) for _, p, s in held)
    recall = [np.mean([p == t for t, p, _ in held if t == k]) for k in (0, 1)]
    return recall


def test_quality_on_held_out(spark):
    rows = quality.op3_quality(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000 and min(held_out_accuracy(spark, rows, "quality")) > 0.93


def test_toxicity_on_held_out(spark):
    rows = toxicity.op10_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000 and min(held_out_accuracy(spark, rows, "toxic")) > 0.85


def brute_segments(scores):
    """All maximal segments, found by their definition: split recursively at the best segment, of equal ones the shortest."""
    def inside(lo, hi):
        best, where = 0.0, None
        for b in range(lo, hi):
            for e, s in enumerate(accumulate(scores[b:hi]), b + 1):
                if s > 0 and (where is None or (s, b - e) > (best, where[0] - where[1])):
                    best, where = s, (b, e)
        if where is None:
            return []
        b, e = where
        return inside(lo, b) + [(b, e, best)] + inside(e, hi)

    return inside(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=14))
def test_segments_are_maximal(scores):
    got = toxicity.segments([float(s) for s in scores])
    want = brute_segments([float(s) for s in scores])
    assert sorted(s for *_, s in got) == sorted(s for *_, s in want)
    assert all(math.isclose(sum(scores[b:e]), s) for b, e, s in got)
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_passages_name_their_words(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(k, f"w{k % 7} w{k % 11} fine " + ("you vilething now" if k % 2 else "you kind one now") + f" w{k % 5}") for k in range(400)], "doc_id long, text string")
    model = toxicity.train(docs, calibration.labelled_sample(labels, "toxic", calibration.not_remainder(4, 2), 1000))
    seen = spark.createDataFrame([(1, "hello " * 30 + "VILETHING! " + "hello " * 30, 1.0), (2, None, 1.0), (3, "", 1.0), (4, "w1 fine you kind", 1.0), (5, "vilethings " * 5000, 1.0)], "doc_id long, text string, n_chars double")
    got = {r.doc_id: r for r in toxicity.score_toxicity(seen, model, ["doc_id"]).collect()}
    assert [(p.begin, p.end, p.text) for p in got[1].passages] == [(30, 31, "VILETHING")]
    assert got[1].score > 0.5 > got[4].score and not got[2].passages and got[2].score == got[3].score < 0.3
    assert toxicity.score_toxicity(seen.where("false"), model, ["doc_id"]).count() == 0
    none = toxicity.train(docs, calibration.labelled_sample(labels.where("toxic = 0"), "toxic", calibration.not_remainder(4, 2), 1000))
    assert {r.score for r in toxicity.score_toxicity(seen, none, ["doc_id"]).collect()} == {0.0}


def test_quality_edges(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)] + [(5, None, 0), (None, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(k, f"good plain words in a row {chr(97 + k % 26)}lo " * (1 + k % 5) if k % 2 else f"bad! BAD{chr(65 + k % 26)}! " * (3 + k % 6)) for k in range(300)] + [(7, None), (8, "")], "doc_id long, text string")
    model = quality.train(docs, calibration.labelled_sample(labels, "quality", calibration.not_remainder(5, 0), 500))
    seen = spark.createDataFrame([(1, "good plain words in a line below " * 3, 2), (2, "bad! BADX! " * 5, 2), (3, None, 2), (4, "", 2), (5, "x" * 300_000, 2)], "doc_id long, text string, y int")
    got = {r.doc_id: r.score for r in quality.score_quality(seen, model, ["doc_id"]).collect()}
    assert got[1] > 0.7 > 0.3 > got[2] and got[3] == got[4] and all(0 <= s <= 1 for s in got.values())
    empty = quality.train(docs, calibration.labelled_sample(labels.where("false"), "quality", calibration.not_remainder(5, 0), 500))
    assert {r.score for r in quality.score_quality(seen, empty, ["doc_id"]).collect()} == {0.5}


def test_statistics_do_not_mix_texts():
    texts = ["One two two.\nThree!", None, "", "É|É|É", "a a a a"]
    both = quality.statistics(pa.array(texts))
    for k, t in enumerate(texts):
        assert np.allclose(both[k], quality.statistics(pa.array([t], pa.string()))[0])
    by = dict(zip(quality.STATISTICS, both[4]))
    assert by["same_next"] == 0.75 and by["top_word"] == 1 and by["repeats"] == 0.5


def test_isotonic_equals_pooling(spark):
    rng = np.random.default_rng(2)
    rows = [(float(a), int(rng.random() < a), float(rng.integers(1, 4))) for a in rng.uniform(0, 1, 120)]
    curve = calibration.isotonic(spark.createDataFrame(rows, "raw double, y int, weight double"), "raw", 0, 1, bins=20)
    bins = []
    for k in range(20):
        mine = [r for r in rows if min(19, int(r[0] * 20)) == k]
        if mine:
            bins.append((sum(r[2] for r in mine), sum(r[2] * r[1] for r in mine), sum(r[2] * r[0] for r in mine)))
    w, s, x = np.array(bins).T
    n = len(w)
    mean = lambda a, b: s[a : b + 1].sum() / w[a : b + 1].sum()
    fit = [max(min(mean(a, b) for b in range(k, n)) for a in range(k + 1)) for k in range(n)]  # the least-squares monotone fit
    groups = [[k for k in range(n) if abs(fit[k] - v) < 1e-12] for v in sorted(set(np.round(fit, 12)))]
    assert np.allclose(curve.x, [x[g].sum() / w[g].sum() for g in groups])
    assert np.allclose(curve.p, [(s[g].sum() + 0.5) / (w[g].sum() + 1) for g in groups]) and 1 < len(groups) < n
    assert calibration.isotonic(spark.createDataFrame([], "raw double, y int, weight double"), "raw", 0, 1)(np.zeros(2)).tolist() == [0.5, 0.5]


def test_quality_model_equals_brute_force(spark):
    docs = [(k, f"good plain words in a row {chr(97 + k % 26)}lo " * (1 + k % 5) if k % 3 else f"bad! BAD{chr(65 + k % 26)}! " * (3 + k % 6)) for k in range(200)]
    sample = spark.createDataFrame([(k, int(k % 3 > 0), 1.0 + k % 2, k % 4) for k in range(200)], "key long, y int, weight double, fold int")
    model = quality.train(spark.createDataFrame(docs, "doc_id long, text string"), sample)
    first = {}
    for k, t in docs:
        first.setdefault((t, int(k % 3 > 0)), k)  # equal texts once, by the least key
    use = [k for k in first.values() if k % 4 < 3]
    x = quality.statistics(pa.array([docs[k][1] for k in use]))
    y, w = np.array([k % 3 > 0 for k in use], float), np.array([1.0 + k % 2 for k in use])
    mean = (w @ x) / w.sum()
    assert np.allclose(model.mean, mean)
    z = model.features(x)
    gram = (z * w[:, None]).T @ z
    want = np.linalg.solve(gram + quality.RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), (z * w[:, None]).T @ y)
    assert np.allclose(model.features(x) @ model.weights, z @ want, atol=1e-6)


def test_toxicity_model_and_scores_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    plain, vile = [f"w{k}ord" for k in range(30)], ["vilething", "horridest", "bad"]
    texts = [" ".join([*rng.choice(plain[: 20 if k % 2 else 30], 12), *(rng.choice(vile, 2) if k % 2 else ["kindly"])]) for k in range(240)]
    sample = spark.createDataFrame([(k, k % 2, 1.0, k // 2 % 4) for k in range(240)], "key long, y int, weight double, fold int")
    model = toxicity.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sample)

    def levels(word):
        return [("", word)] + [(k, word[:k]) for k in toxicity.BEGINNINGS if len(word) > k]

    docs, n = {}, [0, 0]
    for k, t in enumerate(texts):
        if k // 2 % 4 < 3:
            n[k % 2] += 1
            for key in {x for w in t.split() for x in levels(w)}:
                docs.setdefault(key, [0, 0])[k % 2] += 1
    odds = {}
    for key, (c0, c1) in docs.items():
        all_, prior = sum(n), toxicity.PRIOR * (c0 + c1) / sum(n)
        a, b = c1 + prior * n[1] / all_, c0 + prior * n[0] / all_
        v = math.log(a / (n[1] + toxicity.PRIOR * n[1] / all_ - a + 0.5)) - math.log(b / (n[0] + toxicity.PRIOR * n[0] / all_ - b + 0.5))
        z = v / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if (c1 if v > 0 else c0) >= toxicity.LEAST_DOCS and abs(z) >= toxicity.LEAST_Z and abs(v) >= toxicity.LEAST_ODDS:
            odds[key] = max(-12.0, min(12.0, v))
    assert np.allclose(sorted(odds.values()), sorted(model.odds)) and min(odds.values()) < 0 < max(odds.values())
    for t in ["kindly vilethings w1ord horridest kindly", "bad kindly kindly kindly bad", "nothing here", "", *texts[:20]]:
        scores = [next((odds[x] for x in levels(w) if x in odds), 0.0) - toxicity.DRIFT for w in t.split()]
        best = max((s for *_, s in brute_segments(scores)), default=None)
        want = toxicity.LOW if best is None else model.rate * best - math.log(model.scale * len(scores))
        got = model.strongest(model.passages(pa.array([t])))[0]
        assert abs(got - min(toxicity.HIGH, max(toxicity.LOW, want))) < 1e-6, t


def test_sample_is_bounded_and_weighted(spark):
    labels = spark.range(20_000).selectExpr("id AS doc_id", "cast(id % 10 = 0 AS int) AS toxic")
    rows = calibration.labelled_sample(labels, "toxic", calibration.not_remainder(4, 2), 500).collect()
    for y in (0, 1):
        mine = [r for r in rows if r.y == y]
        assert abs(len(mine) - 500) < 120 and abs(sum(r.weight for r in mine) - (13_500 if y == 0 else 1500)) < 3500
