"""What grows with a table: files, tasks and Python workers, not the driver's calls nor one task's share."""

import json
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens
from corpusloom.plans import catalogue, jobqueries, roundtrips
from corpusloom.sources import readers, sinks

SF = "/root/testdata/sf0.001"


@contextmanager
def driver_calls(spark, monkeypatch):
    """How many calls the driver's Python makes to its JVM."""
    client, made = spark.sparkContext._gateway._gateway_client, [0]
    send = client.send_command

    def counted(*a, **b):
        made[0] += 1
        return send(*a, **b)

    with monkeypatch.context() as m:
        m.setattr(client, "send_command", counted)
        yield made


def test_named_files_cost_the_driver_nothing(spark, tmp_path, monkeypatch):
    calls = []
    for n in (4, 60):
        rows = spark.range(n).select(F.concat(F.lit("a "), "id", F.lit("=.json")).alias("name"), F.concat(F.lit("é"), "id").alias("value"))
        with driver_calls(spark, monkeypatch) as made:
            roundtrips.named_files(rows.union(rows.limit(1)), str(tmp_path / f"f{n}"))
        calls.append(made[0])
        got = {f.name: f.read_text() for f in (tmp_path / f"f{n}").iterdir()}
        assert got == {f"a {k}=.json": f"é{k}\n" * (1 + (k == 0)) for k in range(n)}
    assert calls[1] < calls[0] + 112  # 56 more files


def test_a_failing_task_leaves_no_file(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, value string").coalesce(1)
    with pytest.raises(Exception):
        sinks.write_named(rows.withColumn("value", F.when(F.col("name") == "b", F.raise_error(F.lit("x")).cast("string")).otherwise(F.col("value"))), str(tmp_path / "out"))
    assert all(f.name == "a" for f in (tmp_path / "out").iterdir())


def test_json_files_of_any_content(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for name, content in (("x 1", json.dumps({"translations": [["é", "\n"]]}).encode()), ("empty", b""), ("broken", b"{"), ("binary", b"\xff\xfe")):
        (tmp_path / f"t/{name}.thy_output.json").write_bytes(content)
    assert [(r.file, r.translations) for r in readers.proof_traces(spark, str(tmp_path / "t")).collect()] == [("x 1.thy_output.json", [["é", "\n"]])]


def contents(path):
    return {str(f.relative_to(path)): f.read_text() for f in path.rglob("*") if f.is_file() and f.name[0] not in "._"}


def test_shards_cost_the_driver_nothing(spark, tmp_path, monkeypatch):
    calls = []
    for n in (4, 60):
        df = spark.range(n).select(F.col("id").cast("string").alias("text"), (F.col("id") % 2).alias("split"))
        with driver_calls(spark, monkeypatch) as made:
            sinks.write_splits(df, str(tmp_path / f"s{n}"), rows=1, stem="x")
        calls.append(made[0])
        assert len(contents(tmp_path / f"s{n}")) == n
    assert calls[1] < calls[0] + 112


def test_splits_of_any_name(spark, tmp_path, monkeypatch):
    """Null and empty names are one split, as they are one folder; a store that only Spark knows gets the same files."""
    names = ["a:b/c", "é %", "", None, "plain"]
    df = spark.createDataFrame([(k, names[k % 5]) for k in range(35)], "id int, split string").coalesce(1)
    sinks.write_splits(df, str(tmp_path / "one"), rows=4, stem="x")
    one = contents(tmp_path / "one")
    assert {len(t.splitlines()) for f, t in one.items() if f.startswith("split=__HIVE")} == {4, 2}
    assert sorted((json.loads(line)["id"]) for t in one.values() for line in t.splitlines()) == list(range(35))
    read = spark.read.option("basePath", str(tmp_path / "one")).json(str(tmp_path / "one"))
    assert sorted((r.id, r.split or "") for r in read.collect()) == sorted((k, names[k % 5] or "") for k in range(35))
    monkeypatch.setattr(sinks, "_known", lambda path: False)
    sinks.write_splits(df, str(tmp_path / "two"), rows=4, stem="x")
    assert contents(tmp_path / "two") == one


def test_both_counts_in_one_worker(spark, monkeypatch):
    df = catalogue.QUERIES["token_counts"](spark, SF)
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(50).collect()] + [None, "", "a"]
    monkeypatch.setattr(tokens, "SLICE_BYTES", 3000)
    import pyarrow as pa

    for some in (texts, texts[:1], [None], []):
        parts = list(tokens._slices(pa.array(some, pa.string())))
        assert [t for p in parts for t in p.to_pylist()] == some
        assert all(len(p) <= 1 or sum(len((t or "").encode()) for t in p.to_pylist()) <= 3000 for p in parts)


def test_streamed_files_follow_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobqueries, "STREAM_FILE_BYTES", 20_000, raising=False)
    monkeypatch.setattr(jobqueries, "scratch_path", lambda spark, name: str(tmp_path / name))
    size = spark.read.parquet(f"{SF}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    got = [r.doc_id for r in jobqueries.stream_kept(spark, SF).collect()]
    assert len(got) == len(set(got)) > 0
    assert len(list((tmp_path / "stream/in").glob("*.parquet"))) > max(5, size / 40_000)


def test_near_dedup_sends_workers_small_batches(spark):
    from corpusloom import session

    before = {k: spark.conf.get(k) for k in session.BATCH_CONF}
    with session.small_batches(spark), session.small_batches(spark):
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 1000
        sizes = spark.range(3000, numPartitions=1).mapInArrow(lambda batches: batches, "id bigint")
        assert sizes.count() == 3000
    assert {k: spark.conf.get(k) for k in session.BATCH_CONF} == before


def test_workers_hold_slices_of_a_batch():
    """What language ID, decontamination and packing need beside a batch of 6 MB doesn't follow the batch."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from corpusloom.llm import decontamination, langid, packing
    from corpusloom.llm.arrowtext import slices

    rng = np.random.default_rng(3)
    words = np.array(["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(2000)])
    texts = pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choice(words, 300)) for _ in range(2800)])], ["text"])
    windows = decontamination.Windows(["a"], [texts.column("text")[5].as_py()])
    ids = [rng.integers(0, 50_000, 700).astype("<u2") for _ in range(2800)]
    sizes = np.array([len(x) for x in ids])
    columns = {"name": pa.array(range(2800)), "n_tokens": pa.array(sizes), "ids": pa.array([x.tobytes() for x in ids], pa.binary()), "key": pa.array(range(2800)), "begin": pa.array(np.cumsum(sizes) - sizes)}
    tokens = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def language():
        for part in slices([texts], limit=langid.SLICE):
            langid.grams(part.column("text"))

    def decontaminated():
        for part in slices([texts], limit=decontamination.SHARD_BYTES):
            windows.search(part.column("text"))

    def peak(f):
        tracemalloc.start()
        f()
        most = tracemalloc.get_traced_memory()[1] / 2**20
        tracemalloc.stop()
        return most

    pieces = []
    held = [peak(language), peak(decontaminated), peak(lambda: pieces.extend(b for b in packing.pieces_of([tokens], int(sizes.sum()), 1024)))]
    assert held[0] < 50 and held[1] < 60 and held[2] < 8, held
    assert len(pieces) == 4 and b"".join(x for b in pieces for x in b.column("ids").to_pylist()) == np.concatenate(ids).astype("<u4").tobytes()
