import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import pii as P


def luhn(d):
    return sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    """The contract's patterns, as they are written."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet="a1.@-+( )%é_2", max_size=60), st.text(alphabet="0123456789 -.", max_size=60), st.from_regex(r"(\+?[0-9][0-9 ().-]{5,20}|[a-z.]{1,5}@[a-z.]{1,9}|[0-9]{1,3}(\.[0-9]{1,3}){2,5}| ){1,4}", fullmatch=True)))
def test_patterns(text):
    assert P.base_spans(text) == brute(text)


def test_patterns_on_planted():
    text = "4111 1111 1111 1111 a.b@c.d.e, 1.2.3.4.5.6.7.8 +1 (327) 555-3642 256.1.1.1 000255.1.1.1 a@b@c.d @x.y"
    assert P.base_spans(text) == brute(text) and len(brute(text)) == 6


def test_query(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    rows = P.op9_pii(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == b[0] for b in base) for k in P.BASE_KINDS]
        written = [f"{k}:{b}:{e}" for k, b, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(written) <= set(every) and len(set(every)) == len(every)
        assert r.n_network == len(every) - len(written) and r.n_secret == sum(x.startswith("secret") for x in every)
        for kind, b, e in (x.split(":") for x in set(every) - set(written)):  # what the network adds overlaps no pattern span
            assert all(int(e) <= b2 or e2 <= int(b) for _, b2, e2 in base) and P._fits(kind, texts[r.doc_id][int(b) : int(e)])
    assert sum(r.n_network for r in rows) > 0


def test_gradient():
    model, rng = P.Tagger.fresh(), np.random.default_rng(0)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    seen, tags = rng.integers(0, P.N_CODES, (3, 12)).astype(np.uint8), rng.integers(0, P.N_TAGS, (3, 12)).astype(np.uint8)
    _, grads = model.gradient(seen, tags)
    for name, v in model.p.items():
        at = (int(seen[0, 0]), 1) if name == "embed" else tuple(rng.integers(0, n) for n in v.shape)
        was = v[at]
        v[at] = was + 0.01
        up, _ = model.gradient(seen, tags)
        v[at] = was - 0.01
        down, _ = model.gradient(seen, tags)
        v[at] = was
        assert abs((up - down) / 0.02 - grads[name][at]) < 1e-3


def test_network_finds_what_patterns_miss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = P.train(docs.where("doc_id % 3 <> 0"))
    texts = [t for (t,) in docs.where("doc_id % 3 = 0 AND text RLIKE '[0-9@]'").select("text").collect()]
    hit = total = base_hit = base_total = extra = cards = 0
    for t, (base, added) in zip(texts, P.all_spans(texts, model)):
        secrets = {s for s in P.labelled_spans(t) if s[0] == "secret"}
        hit, total = hit + len(secrets & set(added)), total + len(secrets)
        pairs = {("card", b, e) for m in re.finditer(r"(?<![0-9])([0-9]{16}) ([0-9]{16})(?![0-9])", t) for b, e in (m.span(1), m.span(2)) if luhn(t[b:e])}
        cards += len(pairs & set(added))
        extra += len(set(added) - secrets - pairs)
        begins, seen = P.windows_of(P.codes(t)), P.codes(t)
        found = set(P.reconcile(begins, model.decode(P.cut(seen, begins)), seen))
        base = {s for s in base if s[0] != "card"}  # a lone run of 16 digits is the pattern's, by its check digit
        base_hit, base_total = base_hit + len(base & found), base_total + len(base)
    assert total > 20 and hit > 0.95 * total and extra < 0.05 * total and base_hit > 0.9 * base_total
    # the same kinds in other writing, and what only looks like them, in text that it has not seen
    rng, around = np.random.default_rng(99), "the erheble ofon thinst erans "
    right = wrong = n = 0
    for _ in range(400):
        pieces = P.made_up(rng)
        want, at = set(), len(around)
        for t, kind in pieces:
            want |= {(kind, at, at + len(t))} if kind else set()
            at += len(t)
        ((base, added),) = P.all_spans([around + "".join(t for t, _ in pieces) + " " + around], model)
        n, right, wrong = n + len(want), right + len(want & {*base, *added}), wrong + (not want and bool(added))
    assert right > 0.9 * n and wrong < 0.03 * 400


def test_decoding_equals_all_sequences():
    import itertools

    rng = np.random.default_rng(2)
    for _ in range(5):
        e, step = rng.normal(size=(5, 3, 4)), rng.normal(size=(4, 4))
        got = P.best_tags(e, step)
        for w in range(3):
            value = lambda s: sum(e[t, w, k] for t, k in enumerate(s)) + sum(step[a, b] for a, b in zip(s, s[1:]))  # noqa: B023, E731
            assert tuple(got[w]) == max(itertools.product(range(4), repeat=5), key=value)
    model = P.Tagger.fresh()
    tags = model.decode(rng.integers(0, P.N_CODES, (40, P.WINDOW)).astype(np.uint8))
    inside = (tags > 0) & (tags % 2 == 0)
    assert all(row[k - 1] in (row[k] - 1, row[k]) for row, some in zip(tags, inside) for k in np.flatnonzero(some) if k)


def test_decoding_holds_some_windows_at_once():
    """Beyond the windows and their tags, memory doesn't follow their number; the tags are those of fewer windows."""
    import tracemalloc

    seen, model, peaks = np.random.default_rng(6).integers(0, P.N_CODES, (2048, P.WINDOW)).astype(np.uint8), P.Tagger.fresh(), []
    for n in (512, 2048):
        tracemalloc.start()
        tags = model.decode(seen[:n])
        peaks.append(tracemalloc.get_traced_memory()[1] / 2**20)
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 4 and peaks[1] < 64
    assert tags.shape == seen.shape and (tags[500:530] == model.decode(seen[500:530])).all()


def test_windows_left_out_can_add_nothing():
    rng, model = np.random.default_rng(4), P.Tagger.fresh()  # untrained, so it sees spans everywhere
    for _ in range(20):
        text = "".join(rng.choice(list("abc .-")) if rng.random() < 0.97 else rng.choice(list("0@")) for _ in range(700))
        seen = P.codes(text)
        every = np.arange(-2, len(seen) // P.STRIDE + 1).clip(0) * P.STRIDE
        every = np.unique(every)
        some = P.windows_of(seen)
        assert set(some) <= set(every)
        spans = [P.reconcile(b, model.decode(P.cut(seen, b)), seen) for b in (every, some)]
        assert spans[0] == spans[1]


def test_reconcile_merges_windows():
    tags, seen = np.zeros((2, P.WINDOW), np.uint8), np.full(200, 2, np.uint8)
    seen[94], seen[100] = 1, 6
    tags[0, 92], tags[0, 93:] = 1, 2  # cut by the end of the first window
    tags[1, 60], tags[1, 61:72] = 1, 2
    assert P.reconcile(np.array([0, 32]), tags, seen) == [("email", 92, 104)]
    tags[1, 60], tags[1, 61:72] = 3, 4  # seen whole as another kind
    assert P.reconcile(np.array([0, 32]), tags, seen) == [("ip", 92, 104)]
    assert P.reconcile(np.array([0, 32]), tags, np.full(200, 2, np.uint8)) == []  # without a digit or @


def test_edges_and_redaction(spark, monkeypatch):
    monkeypatch.setattr(P, "STEPS", 20)
    rows = [(1, None, "x", None), (2, "", "x", 0), (3, "mail me@example.com now, +1 (555) 123-4567", "x", 42), (3, "é" * 50_000 + "1.2.3.4", "x", 0), (None, "no data", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = P.redacted_documents(spark, docs, "")
    assert got.columns == docs.columns
    got = got.collect()
    assert [r.text for r in got[:3]] == [None, "", "mail [EMAIL] now, [PHONE]"] and got[2].n_chars == len(got[2].text)
    assert got[3].text == "é" * 50_000 + "[IP]" and got[4].n_chars == 7
    assert P.train(docs.where("doc_id = 2")) is None
    assert P.find_spans(docs.select("doc_id", "text"), None, ["doc_id"]).collect()[2].spans == "email:5:19,phone:25:42"
    assert P.redacted_documents(spark, docs.where("false"), "").count() == 0
    odd = docs.select("text", F.col("doc_id").alias("a.b"), F.lit(1).alias("_row"))  # no n_chars, and a name with a dot
    assert P.redacted_documents(spark, odd, "").columns == odd.columns and P.redacted_documents(spark, odd, "").count() == 5
