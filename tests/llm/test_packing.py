import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from corpusloom.llm import packing as P


def check(pieces, docs, max_tokens=1024):
    """Every id in exactly one piece, gapless sequences, and lengths that need no padding."""
    bpe = Tokenizer.from_file(P.default_vocabulary())
    want = {k: bpe.encode(t or "", add_special_tokens=False).ids + [0] for k, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for k, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[k])
            assert p.ids_crc32 == zlib.crc32(np.array(want[k][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(want[k])
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= max_tokens and at & (at - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    check(P.op2_packing(spark, d).collect(), docs)


def test_edges(spark):
    texts = [None, "", "a", "<|endoftext|> x", "x" * 9000, "\n" * 5000, " " * 3000 + "é", "it's 12 ½ ²³ 　 end ", "same", "same"] + ["word " * 40] * 30
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, 0) for k, t in docs], "doc_id long, text string, row long")
    check(P.with_digest(P.pack(df, max_tokens=64)).collect(), docs, 64)
    assert P.pack(df.where("false")).count() == 0


def test_pieces_follow_the_curve(spark):
    d = "/root/testdata/sf0.01"
    pieces = P.pack(spark.read.parquet(f"{d}/documents.parquet")).select("doc_id", "sequence_id", "offset", "start", "curve_key").collect()
    keys = [p.curve_key for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    assert keys == sorted(keys) and len(set(keys)) > 100
    rng = np.random.default_rng(1)
    topics = [[f"{a}{j}" for j in range(30)] for a in ("alpha", "beta", "gamma")]  # neighbours on the curve are alike
    docs = [(k, " ".join(rng.choice(topics[k % 3], 60))) for k in range(300)]
    rows = P.pack(spark.createDataFrame(docs, "doc_id long, text string"), max_tokens=256).collect()
    line = [p.doc_id % 3 for p in sorted(rows, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    assert sum(a == b for a, b in zip(line, line[1:])) > 0.6 * len(line)  # by chance, a third


def test_hilbert_visits_neighbours():
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        key = P.hilbert_key(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_sequence_edges():
    assert P.sequence_edges(1024 + 700, 1024).tolist() == [1024, 1536, 1664, 1696, 1712, 1720, 1724]
    assert P.sequence_edges(0, 8).tolist() == [0] and P.sequence_edges(8, 8).tolist() == [8]
