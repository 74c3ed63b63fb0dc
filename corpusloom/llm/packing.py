"""Packing along a space-filling curve.

A document's tokens, hashed and projected to a few dimensions, place it in space; each
dimension is cut at its quantiles, and the cells are ordered by a Hilbert curve. Documents are
range-sorted by that key and laid end to end; every max_tokens tokens are a sequence, so
neighbours in space share sequences. The last, shorter stretch becomes sequences whose lengths
are powers of two, so no sequence is padded.

The sort moves keys only. The tokens move once, when each document meets its position.

A null text counts as empty, and an empty one is the single end id. Repeated rows are packed
each for itself. No rows give no pieces. Other columns are ignored, whatever their names.
A task holds a slice of 1 MB of text, or of tokens, at a time, or one longer text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrowtext import mix, over_texts, release, slices
from corpusloom.session import small_batches, stored, table

MAX_TOKENS, END_ID = 1024, 0
#: Dimensions, bits of each (so many quantile cells), and buckets of the hashed document vectors.
DIMENSIONS, BITS, BUCKETS = 4, 7, 1 << 14
#: Runs without a break of this many characters go to the library whose time doesn't grow with their square.
LONG_RUN = 2000
#: Bytes of text, and of tokens, that a worker holds at once.
SLICE = 1 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteBPE:
    """The ids that tokenizers gives for a byte-level BPE file, by tiktoken where the two must agree.

    They agree if the vocabulary is the 256 bytes followed by the merges in order, and the file's
    pre-tokenizer is the usual byte-level one; otherwise, and for long runs, tokenizers does it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = self._tiktoken(spec)
        self.size = self.slow.get_vocab_size()

    @staticmethod
    def _tiktoken(spec):
        import tiktoken

        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges"):
            return None
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the rest are 256 on
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocabulary = model["vocab"]
        if any(vocabulary.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in added}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def ids(self, text: str) -> np.ndarray:
        if self.fast and max(map(len, text.split()), default=0) < LONG_RUN and not any(c * LONG_RUN in text for c in " \n\t"):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def tokenized(docs: DataFrame, keep: list[str], text: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """The kept columns, n_tokens, ids (little-endian, 16 bits if the vocabulary allows), and the projection."""

    def make():
        bpe = ByteBPE(vocabulary)
        kind = "<u2" if bpe.size <= 1 << 16 else "<u4"
        rng = np.random.default_rng(0)
        buckets = rng.normal(size=(BUCKETS, DIMENSIONS)).astype(np.float32)
        hashed = mix(np.arange(bpe.size, dtype=np.uint64))
        project = buckets[(hashed % np.uint64(BUCKETS)).astype(np.int64)] * np.where(hashed >> np.uint64(63), 1, -1)[:, None].astype(np.float32)

        def each(part):
            sizes, ids, places = [], [], np.zeros((part.num_rows, DIMENSIONS), np.float32)
            for k, t in enumerate(part.column(text).to_pylist()):
                x = np.append(bpe.ids(t) if t else np.zeros(0, np.uint32), np.uint32(end_id))
                sizes.append(len(x))
                ids.append(x.astype(kind).tobytes())
                places[k] = project[x].sum(0) / np.sqrt(len(x))
            return {"n_tokens": pa.array(sizes, pa.int64()), "ids": pa.array(ids, pa.binary()), "place": pa.array(list(places), pa.list_(pa.float32()))}

        return each

    return over_texts(docs, keep, "n_tokens bigint, ids binary, place array<float>", make, text, SLICE)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of cells (n x dimensions, each below 2**bits).

    Gray-code form (Skilling, 2004): undo rotations from the highest bit down, then interleave.
    """
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            high = (x[i] >> b & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where(x[d - 1] >> b & 1, turn ^ ((1 << b) - 1), turn)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_order(places: DataFrame) -> DataFrame:
    """(row, key): places cut at their quantiles and put on the curve."""
    share = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    cuts = places.agg(*(F.percentile_approx(F.col("place")[k], share, 2000).alias(f"d{k}") for k in range(DIMENSIONS))).first()
    edges = [np.array(c if c is not None else [], np.float32) for c in cuts]

    def keys(batches):
        for b in batches:
            if b.num_rows:
                at = np.array(b.column("place").to_pylist(), np.float32).reshape(b.num_rows, DIMENSIONS)
                cells = np.stack([np.searchsorted(e, at[:, k], "right") for k, e in enumerate(edges)], 1)
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n_tokens"), pa.array(hilbert_key(cells, BITS))], ["row", "n_tokens", "key"])

    return places.select("row", "n_tokens", "place").mapInArrow(keys, "row bigint, n_tokens bigint, key bigint")


def positions(ordered: DataFrame) -> tuple[DataFrame, int]:
    """(row, key, begin) in the order of key and row, begin being the tokens before; and the total.

    A running sum over range partitions: each task sums its own, and the totals of the tasks,
    one number each, give where each begins.
    """

    def run(batches):
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column("n_tokens").to_numpy()
            begin = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("key"), pa.array(np.full(len(n), part, np.int64)), pa.array(begin), b.column("n_tokens")], ["row", "key", "part", "local", "n_tokens"])

    local = ordered.repartitionByRange("key", "row").sortWithinPartitions("key", "row").mapInArrow(run, "row bigint, key bigint, part bigint, local bigint, n_tokens bigint")
    local = stored(local, "positions")
    sums = sorted(tuple(r) for r in local.groupBy("part").agg(F.sum("n_tokens")).collect())  # a row per task
    begins, total = [], 0
    for part, n in sums:
        begins.append((part, total))
        total += n
    before = local.sparkSession.createDataFrame(begins, "part bigint, before bigint")
    return local.join(F.broadcast(before), "part").select("row", "key", (F.col("before") + F.col("local")).alias("begin")), total


def sequence_edges(total: int, max_tokens: int) -> np.ndarray:
    """Where the sequences of the last, shorter stretch begin, and the end: powers of two, falling."""
    edges, at, rest = [], total - total % max_tokens, total % max_tokens
    for b in range(max_tokens.bit_length() - 1, -1, -1):
        if rest >> b & 1:
            edges.append(at)
            at += 1 << b
    return np.array([*edges, total], np.int64)


def pieces_of(batches: Iterator[pa.RecordBatch], total: int, max_tokens: int) -> Iterator[pa.RecordBatch]:
    """The pieces of each document of the batches, a slice of its tokens at a time; total is the tokens of all documents."""
    tail, whole = sequence_edges(total, max_tokens), total // max_tokens
    for b in slices(batches, "ids", SLICE):
        out: dict[str, list] = {c: [] for c in ("source", "start", "length", "ids", "sequence_id", "offset")}
        ids, n, begin = b.column("ids"), b.column("n_tokens").to_numpy(), b.column("begin").to_numpy()
        for k in range(b.num_rows):
            raw, size, g = ids[k].as_py(), int(n[k]), int(begin[k])
            x = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4").astype("<u4").tobytes()
            done = 0
            while done < size:
                p = g + done
                if p < whole * max_tokens:
                    s, offset = divmod(p, max_tokens)
                    room = max_tokens - offset
                else:
                    j = int(np.searchsorted(tail, p, "right")) - 1
                    s, offset, room = whole + j, p - int(tail[j]), int(tail[j + 1]) - p
                length = min(room, size - done)
                for c, v in zip(out, (k, done, length, x[4 * done : 4 * (done + length)], s, offset)):
                    out[c].append(v)
                done += length
        source = pa.array(out.pop("source"), pa.int64())
        made = {c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in out.items()}
        taken = {c: pc.take(b.column(c), source) for c in ("name", "key")} | {"doc_tokens": pc.take(b.column("n_tokens"), source)}
        names = ["name", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "key"]
        yield pa.RecordBatch.from_arrays([(made | taken)[c] for c in names], names)
    b = out = ids = made = taken = None
    release()


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """The pieces that documents are cut into.

    Columns: key, start and length (tokens of the document), ids (binary, little-endian 32
    bits), doc_tokens, sequence_id, offset (in the sequence), and curve_key.
    """
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("name"), F.col(f"`{text}`").alias("text"))
    with small_batches(docs.sparkSession):
        rows = stored(tokenized(rows, ["row", "name"], "text", vocabulary), "tokens")
    at, total = positions(curve_order(rows))
    placed = rows.select("row", "name", "n_tokens", "ids").join(at, "row").select("name", "n_tokens", "ids", "key", "begin")
    kind = placed.schema["name"].dataType.simpleString()
    pieces = placed.mapInArrow(lambda batches: pieces_of(batches, total, max_tokens), f"name {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, key bigint")
    return pieces.withColumnsRenamed({"name": key, "key": "curve_key"})


def with_digest(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    return pieces.select(key, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digest(pack(table(spark, sf_dir, "documents")))
