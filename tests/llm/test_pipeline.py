"""The pipeline against a brute-force version of each stage, on the smallest tables."""

import corpus_pipeline as C
from corpusloom.llm import langid, pii
from corpusloom.session import stored
from tests.llm import test_decontamination, test_neardup, test_packing
from tests.llm.test_pii import brute as patterns


def test_stages(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    extra = [(90_001, None, "en", "x", 0), (90_002, "1234 567", "en", "x", 8), (90_003, "", None, "x", 0)]
    docs = stored(docs.union(spark.createDataFrame(extra, docs.schema)), "in")
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    stages = [f for _, f in C.STAGES]
    before = {r.doc_id: r for r in docs.collect()}

    kept = stored(stages[0](spark, docs, d), "a")
    one = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == docs.columns and set(before) - set(one) == {90_001, 90_002, 90_003}

    kept = stored(stages[1](spark, kept, d), "b")
    two = {r.doc_id: r for r in kept.collect()}
    classes = test_neardup.brute([(k, r.text) for k, r in one.items()])
    assert kept.columns == docs.columns and set(two) == set(classes.values())

    kept = stored(stages[2](spark, kept, d), "c")
    three = {r.doc_id: r for r in kept.collect()}
    found = test_decontamination.brute([(k, r.text) for k, r in two.items()], items)
    assert kept.columns == docs.columns and set(three) == {k for k, v in found.items() if not v[4]} and len(three) < len(two)

    kept = stored(stages[3](spark, kept, d), "d")
    four = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == docs.columns and set(four) == set(three)
    for k, r in four.items():
        assert not patterns(r.text) and r.n_chars == len(r.text)
        if not patterns(three[k].text) and not any(c.isdigit() or c == "@" for c in three[k].text):
            assert r == three[k]
        assert all(s in r.text for s in {f"[{kind.upper()}]" for kind, *_ in patterns(three[k].text)} if len({x[0] for x in patterns(three[k].text)}) == 1)

    test_packing.check(stages[4](spark, kept, d).collect(), [(k, r.text) for k, r in four.items()])


def test_run_returns_the_last_stage(spark):
    rows = C.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and rows.count() > 100


def test_empty_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    for _, stage in C.STAGES:
        docs = stored(stage(spark, docs, "/root/testdata/sf0.001"), "empty")
    assert docs.count() == 0 and langid.UNDETERMINED == "und" and pii.KINDS[0] == "email"
