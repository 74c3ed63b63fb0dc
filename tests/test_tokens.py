"""Token counts against an encoder that merges pair by pair."""

import base64
import math

import pytest
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import functions as F

from corpusloom.functions import tokens
from corpusloom.plans import catalogue


@pytest.fixture(scope="module")
def texts(spark):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    return [*rows[:60], None, "", " ", "   a  b ", "é\U0001f600 x", "don't\n\n stop", rows[0], rows[0]]


def counts(spark, texts, counter):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return {r.k: r.n for r in df.select("k", counter(F.col("t")).alias("n")).collect()}


def test_ranks_by_merging_pairs(spark, texts):
    path = tokens.public_path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}

    def size(word: bytes) -> int:
        parts = [word[k : k + 1] for k in range(len(word))]
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, math.inf), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == math.inf:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return len(parts)

    want = {k: sum(size(w.encode()) for w in regex.findall(public_tokenizers.PATTERN, t or "")) for k, t in enumerate(texts)}
    assert counts(spark, texts, tokens.ranks_counter(path)) == want


def test_pieces_by_merging_pairs(spark, texts):
    """Of texts in ASCII with single spaces, which the model's normalisation leaves as they are."""
    path = tokens.public_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    score = {model.id_to_piece(k): model.get_score(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))}
    plain = [" ".join(t.split()) for t in texts if t and t.isascii() and t.strip()]
    assert len(plain) > 10

    def size(text: str) -> int:
        parts = list("\u2581" + text.replace(" ", "\u2581"))
        while True:
            best, at = max(((score.get(a + b, -math.inf), -k) for k, (a, b) in enumerate(zip(parts, parts[1:]))), default=(-math.inf, 0))
            if best == -math.inf:
                return len(parts)
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]

    plain = [t[:600].rsplit(" ", 1)[0] for t in plain]
    assert all(c in score for t in plain for c in t.replace(" ", "\u2581"))
    assert counts(spark, plain, tokens.pieces_counter(path)) == {k: size(t) for k, t in enumerate(plain)}


def test_query(spark):
    rows = catalogue.QUERIES["token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(r.num_tokens > 0 and r.llama_tokens > 0 for r in rows)
