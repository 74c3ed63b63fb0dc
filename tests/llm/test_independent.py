"""Statistics, calibrated scores and the network's forward pass computed a second time, in plain Python from their definitions."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from corpusloom.llm import pii, quality, toxicity
from tests.llm.test_classifiers import brute_segments

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r", "\n", ".,;:?'\"()-", "!", "|", "#$%&*+/<=>@[\\]^_`{}~"]


def folded(word: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in word)


def plain_statistics(text: str | None) -> list[float]:
    text = text or ""
    size, some = len(text.encode()), max(1, len(text.encode()))
    counts = [sum(c in chars for c in text) for chars in CLASSES] + [sum(len(c.encode()) for c in text if not c.isascii())]
    words = [folded(w) for w in WORD.findall(text)]
    n, sizes = max(1, len(words)), [len(w.encode()) for w in WORD.findall(text)]
    mean = sum(sizes) / n
    spread = math.sqrt(max(0.0, sum(x * x for x in sizes) / n - mean**2))
    grams = [tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    return [
        math.log1p(size), *(math.sqrt(c / some) for c in counts), counts[0] / max(1, counts[0] + counts[1]), mean, spread,
        sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(grams)) / max(1, len(grams)),
        max(Counter(words).values(), default=0) / n, len(set(words)) / n**0.8, math.log1p(size / (counts[4] + 1)),
    ]


def test_quality_statistics(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [None, "", "é|É !!\n\tA1", "a a a a b", "One two", "#x " * 300]
    got = quality.statistics(pa.array(texts))
    assert got.shape[1] == len(quality.STATISTICS) and np.allclose(got, [plain_statistics(t) for t in texts], atol=1e-9)


def plain_isotonic(rows, low, high, bins=1024):
    """A map from raw scores to probabilities: least-squares monotone means of bins, then lines between the groups' places."""
    sums: dict[int, list[float]] = {}
    for raw, y, w in rows:
        k = min(bins - 1, max(0, math.floor((raw - low) / (high - low) * bins)))
        s = sums.setdefault(k, [0.0, 0.0, 0.0])
        s[0], s[1], s[2] = s[0] + w, s[1] + w * y, s[2] + w * raw
    w, s, x = np.array([sums[k] for k in sorted(sums)]).T
    n = len(w)
    fit = [max(min(s[a : b + 1].sum() / w[a : b + 1].sum() for b in range(k, n)) for a in range(k + 1)) for k in range(n)]
    groups: list[list[int]] = []
    for k in range(n):
        if groups and abs(fit[groups[-1][0]] - fit[k]) < 1e-12:
            groups[-1].append(k)
        else:
            groups.append([k])
    place = [x[g].sum() / w[g].sum() for g in groups]
    chance = [(s[g].sum() + 0.5) / (w[g].sum() + 1) for g in groups]
    return lambda raw: float(np.clip(np.interp(raw, place, chance), 0, 1))


def test_quality_scores(spark):
    """From texts and labels to score, without any function of the module but the seeded random numbers."""
    docs = [(k, f"good plain words in a row {chr(97 + k % 26)}lo " * (1 + k % 5) if (k % 3 if k % 11 else k % 2) else f"bad! BAD{chr(65 + k % 26)}! " * (3 + k % 6)) for k in range(300)]
    sample = [(k, int(k % 3 > 0), 1.0 + k % 2, k % 4) for k in range(300)]
    model = quality.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(sample, "key long, y int, weight double, fold int"))
    seen = [docs[0][1], docs[1][1], "good plain bad! words", "", None]
    got = quality.score_quality(spark.createDataFrame(list(enumerate(seen)), "doc_id long, text string"), model, ["doc_id"]).orderBy("doc_id").collect()
    first = {}
    for k, t in docs:
        first.setdefault((t, sample[k][1]), k)
    fit, rest = [k for k in first.values() if sample[k][3] < 3], [k for k in first.values() if sample[k][3] == 3]
    stats = lambda keys: np.array([plain_statistics(docs[k][1]) for k in keys])
    x, y, w = stats(fit), np.array([sample[k][1] for k in fit], float), np.array([sample[k][2] for k in fit])
    mean = (w @ x) / w.sum()
    spread = np.sqrt(np.maximum(1e-6, (w @ x**2) / w.sum() - mean**2))
    rng = np.random.default_rng(quality.SEED)
    turn, shift = rng.normal(0, 1 / quality.WIDTH, (x.shape[1], quality.FEATURES)), rng.uniform(0, 2 * np.pi, quality.FEATURES)
    features = lambda v: np.column_stack([np.ones(len(v)), np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((v - mean) / spread, -6, 6) @ turn + shift)])
    z = features(x)
    gram = (z * w[:, None]).T @ z
    weights = np.linalg.solve(gram + quality.RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), (z * w[:, None]).T @ y)
    raw = features(stats(rest)) @ weights
    curve = plain_isotonic([(round(float(r), 9), sample[k][1], sample[k][2]) for r, k in zip(raw, rest)], -0.5, 1.5)
    want = [curve(round(float(r), 9)) for r in features(np.array([plain_statistics(t) for t in seen])) @ weights]
    assert np.allclose([r.score for r in got], want, atol=1e-5) and len({round(p, 3) for p in want}) > 1


def test_toxicity_extreme_values_and_scores(spark):
    """lambda, K and the calibrated score from the words' log-odds and the texts of the fold for calibration."""
    rng = np.random.default_rng(9)
    plain, vile = [f"w{k}ord" for k in range(30)], ["vilething", "horridest", "bad"]
    texts = [" ".join([*rng.choice(plain[: 20 if k % 2 else 30], 12), *(rng.choice(vile, 2) if k % 2 and k % 7 else ["kindly"])]) for k in range(400)]
    sample = [(k, k % 2, 1.0 + k % 3, k // 2 % 4) for k in range(400)]
    model = toxicity.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(sample, "key long, y int, weight double, fold int"))

    def scores(text):
        """Of each word: its own log-odds, or those of its longest known beginning, less the drift; looked up one word at a time."""
        return [float(model.lookup(toxicity.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[3])[0]) for w in WORD.findall(text)]

    rest = [k for k in range(400) if sample[k][3] == 3]
    assert len({texts[k] for k in range(400)}) == 400
    null = [round((s + 13) * 100) / 100 - 13 for k in rest if sample[k][1] == 0 for s in scores(texts[k])]
    rows = [*((s, 1.0) for s in null), (1.0, 0.5)]
    total = sum(n for _, n in rows)
    excess = lambda rate: math.log(sum(n * math.exp(rate * s) for s, n in rows) / total)
    low, high = 1e-6, 50.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    scale = sum(n for s, n in rows if s > 0) / total
    assert abs(model.rate - low) < 1e-6 and abs(model.scale - scale) < 1e-9

    def strongest(text):
        words = scores(text)
        best = max((s for *_, s in brute_segments(words)), default=None)
        return toxicity.LOW if best is None else min(toxicity.HIGH, max(toxicity.LOW, low * best - math.log(scale * len(words))))

    curve = plain_isotonic([(strongest(texts[k]), sample[k][1], sample[k][2]) for k in rest], toxicity.LOW, toxicity.HIGH)
    seen = ["kindly vilethings w1ord", "bad kindly bad", "nothing here", "", None, *texts[:20]]
    got = toxicity.score_toxicity(spark.createDataFrame(list(enumerate(seen)), "doc_id long, text string"), model, ["doc_id"]).orderBy("doc_id").collect()
    assert np.allclose([r.score for r in got], [curve(strongest(t or "")) for t in seen], atol=1e-5)


def test_pii_forward_pass():
    """Both directions of the LSTM and the linear layer, one window and one unit at a time, in double precision."""
    model = pii.Tagger.fresh()
    rng = np.random.default_rng(4)
    seen = rng.integers(0, pii.N_CODES, (3, 9)).astype(np.uint8)
    got = model.emissions(seen)[0]
    p = {k: v.astype(float).tolist() for k, v in model.p.items()}
    squash = lambda x: 1 / (1 + math.exp(-x))

    def line(letters, d):
        h, c, out = [0.0] * pii.HIDDEN, [0.0] * pii.HIDDEN, []
        for code in letters:
            x = p["embed"][code]
            z = [p[f"c{d}"][j] + sum(x[i] * p[f"x{d}"][i][j] for i in range(pii.EMBED)) + sum(h[i] * p[f"h{d}"][i][j] for i in range(pii.HIDDEN)) for j in range(4 * pii.HIDDEN)]
            n = pii.HIDDEN
            c = [squash(z[n + j]) * c[j] + squash(z[j]) * math.tanh(z[3 * n + j]) for j in range(n)]
            h = [squash(z[2 * n + j]) * math.tanh(c[j]) for j in range(n)]
            out.append(h)
        return out

    for k, window in enumerate(seen.tolist()):
        ahead, behind = line(window, "f"), line(window[::-1], "b")[::-1]
        for t in range(len(window)):
            both = ahead[t] + behind[t]
            want = [p["bias"][j] + sum(both[i] * p["out"][i][j] for i in range(2 * pii.HIDDEN)) for j in range(pii.N_TAGS)]
            assert np.allclose(got[t, k], want, atol=1e-4)


def test_pii_spans_of_a_text_do_not_depend_on_its_neighbours():
    """Spans from each window decoded alone are those from all windows at once, also among other texts."""
    rng = np.random.default_rng(2)
    model = pii.Tagger.fresh()
    made = ["".join(t for _ in range(6) for t, _ in pii.made_up(rng)) for _ in range(60)]
    seen = [pii.codes(t) for t in made]
    begins = [pii.windows_of(s) for s in seen]
    model.fit(*pii.put_into(np.full((4, pii.WINDOW), 2, np.uint8), np.zeros((4, pii.WINDOW), np.uint8), 400), steps=40)
    for t, s, b, (base, added) in zip(made, seen, begins, pii.all_spans(made, model)):
        tags = np.concatenate([model.decode(pii.cut(s, b[k : k + 1])) for k in range(len(b))]) if len(b) else np.zeros((0, pii.WINDOW), int)
        spans = [x for x in pii.reconcile(b, tags, s) if pii._fits(x[0], t[x[1] : x[2]]) and all(x[2] <= b2 or e2 <= x[1] for _, b2, e2 in base)]
        assert sorted(spans) == sorted(added) and base == pii.base_spans(t)
