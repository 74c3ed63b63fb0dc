"""One text of a million characters and more through the operators that had none in their tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.llm import chat, linkgraph, packing, pii, toxicity


def test_packing(spark):
    df = spark.range(2).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 0, F.repeat(F.lit("some words é1 "), 90_000)).otherwise("short").alias("text"))
    rows = packing.with_digest(packing.pack(df)).collect()
    long = sorted((r for r in rows if r.doc_id == 0), key=lambda r: r.start)
    assert [r.start for r in long] == [sum(p.length for p in long[:k]) for k in range(len(long))] and sum(r.length for r in long) == long[0].doc_tokens > 300_000


def test_chat(spark):
    said = "word " * 250_000
    df = spark.createDataFrame([(1, 0, "a", said), (1, 1, "b", "yes")], "conv_id long, turn long, role string, text string")
    rows = chat.rotate_perspectives(df).collect()
    assert len(rows) == 2 and all(said in r.rendered for r in rows)


def test_url_filter(spark):
    html = "<p>" + "text " * 200_000 + '<a href="http://bad.net/es/x">' + "<i>x</i>" * 50_000
    rows = [(1, "http://a.org/" + "x/" * 500_000, html), (2, "http://bad.net/es/x", ""), (3, "http://" + "h" * 1_000_000 + ".org/", None)]
    got = {r.page_id: r for r in linkgraph.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got[1].path) == 1_000_001 and got[2].rule == "net/es/" and len(got[3].host) == 1_000_004 and got[1].verdict in ("allow", "block")


def test_pii(spark):
    text = "plain words without any " * 45_000 + "mail me@example.org or 10.1.2.3 " + "more words " * 10_000
    row = pii.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), pii.Tagger.fresh(), ["doc_id"]).first()
    at = text.index("me@")
    assert row.base == f"email:{at}:{at + 14},ip:{at + 18}:{at + 26}" and len(row.redacted) < len(text)


def test_toxicity(spark):
    model = toxicity.SegmentModel()
    df = spark.createDataFrame([(1, "word " * 400_000)], "doc_id long, text string")
    row = toxicity.score_toxicity(df, model, ["doc_id"]).first()
    assert row.score == 0 and row.passages == []
