"""Readers, writers, whole jobs and streams, over files made here."""

import io
import json
import math
import tarfile

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import external, language, tokens
from corpusloom.operators import decontam, filters
from corpusloom.plans import __main__ as command_line
from corpusloom.plans import jobs
from corpusloom.sources import archives, readers, sinks
from corpusloom.streaming import feeds


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def counter():
    return F.udf(lambda t: len(t.split()), "bigint")


def test_source_tree(spark, tmp_path):
    put(tmp_path / "trees/one/a/x.v", "Theorem\r\na\rb")
    put(tmp_path / "trees/one/y.vo", "no")
    put(tmp_path / "trees/two/z.v", b"\xff\xfe")
    put(tmp_path / "trees/two/w.v", "é")
    rows = {r.path.rsplit("/", 1)[1]: r.text for r in readers.source_tree(spark, str(tmp_path / "trees"), ".v").collect()}
    assert rows == {"x.v": "Theorem\na\nb", "w.v": "é"}
    repos = spark.createDataFrame([("a", "one", "s", "repos/one"), ("b", "two", "t", "repos/two")], "author string, repo string, sha string, save_path string")
    assert {(r.meta.author, r.text) for r in readers.extracted(spark, str(tmp_path / "trees"), ".v", repos).collect()} == {("a", "Theorem\na\nb"), ("b", "é")}


def test_archives(spark, tmp_path):
    for name, files in (("a", {"r/x.v": b"one\r\n", "r/y.c": b"no", "r/z.v": b"\xff"}), ("b", {})):
        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode="w:gz") as tar:
            for n, c in files.items():
                info = tarfile.TarInfo(n)
                info.size = len(c)
                tar.addfile(info, io.BytesIO(c))
        put(tmp_path / f"{name}.tar.gz", raw.getvalue())
    assert [(r.path, r.text) for r in readers.archives(spark, str(tmp_path), ".v").collect()] == [("r/x.v", "one\n")]
    assert readers.archives(spark, str(tmp_path), ".v", max_bytes=5).count() == 0


@pytest.mark.parametrize("most", [100_000, 0])
def test_extracted_joins_repositories(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(readers, "REPOSITORIES_AT_ONCE", most)
    for n in ("one/a.v", "one/b/c.v", "two/a.v", "other/a.v"):
        put(tmp_path / "trees" / n, n)
    repos = spark.createDataFrame([("x", "one", "s", "up/one"), ("y", "two", "t", "up/two")], "author string, repo string, sha string, save_path string")
    rows = readers.extracted(spark, str(tmp_path / "trees"), ".v", repos).collect()
    assert sorted((r.meta.author, r.text) for r in rows) == [("x", "one/a.v"), ("x", "one/b/c.v"), ("y", "two/a.v")]


def test_archives_are_streams(spark, tmp_path):
    """240 MB of members pass in less than 40 MB; a cut archive gives what is before the cut, and its error."""
    import random
    import tracemalloc

    rng = random.Random(1)
    big = tmp_path / "in/big.tar.gz"
    big.parent.mkdir()
    unit = bytes(rng.choices(b"abcdef \n", k=1 << 16))
    with tarfile.open(big, mode="w:gz", compresslevel=1) as tar:
        for k in range(240):
            info = tarfile.TarInfo(f"r/{k}.v")
            info.size = 16 * len(unit)
            tar.addfile(info, io.BytesIO(unit * 16))
    tracemalloc.start()
    rows = 0
    for batch in archives.ArchiveReader([str(big)], ".v").read(archives.ArchivePartition(str(big))):
        rows += batch.num_rows
        del batch
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 240 and peak < 40 << 20
    raw = big.read_bytes()
    put(tmp_path / "in/cut.tar.gz", raw[: len(raw) // 2])
    put(tmp_path / "in/none.tar.gz", b"no archive")
    got = {r.archive.rsplit("/", 1)[-1]: (r.n, r.error) for r in archives.members(spark, str(tmp_path / "in"), ".v").groupBy("archive").agg(F.count("path").alias("n"), F.max("error").alias("error")).collect()}
    assert got["big.tar.gz"] == (240, None) and 100 < got["cut.tar.gz"][0] < 140 and "EOFError" in got["cut.tar.gz"][1]
    assert got["none.tar.gz"][0] == 0 and "BadGzipFile" in got["none.tar.gz"][1]


STUB = """#!/bin/sh
case "$1" in
fails) echo half; echo broken >&2; exit 3;;
hangs) echo half; sleep 100;;
floods) yes;;
binary) printf '\\377';;
quiet) ;;
*) echo "steps of $1, $2"; yes error 2>/dev/null | head -c 300000 >&2;;
esac
"""


def test_steps_by_an_external_program(spark, tmp_path, counter):
    program = tmp_path / "stub"
    put(program, STUB)
    program.chmod(0o755)
    names = ["A.B", "fails", "hangs", "floods", "binary", "quiet", "a b; echo x", None]
    df = spark.createDataFrame([(n,) for n in names], "module string").repartition(4)
    command = [str(program), "{}", "--x"]
    got = {r.module: (r.text, r.code, r.error) for r in external.through_program(df, "module", command, max_output=1 << 20, seconds=3).collect()}
    assert got["A.B"] == ("steps of A.B, --x\n", 0, None) and got["quiet"] == ("", 0, None) and got["a b; echo x"][0] == "steps of a b; echo x, --x\n"
    assert got["fails"] == (None, 3, "broken\n") and "after 3 s" in got["hangs"][2] and "more than" in got["floods"][2] and "decode" in got["binary"][2] and got[None][2] == "no key"
    assert "FileNotFoundError" in external.run_one([str(tmp_path / "absent")], None, 10, 1.0)[2]
    steps = jobs.extracted_steps(df.where("module IN ('A.B', 'fails', 'quiet')"), str(tmp_path / "failed"), command)
    assert sorted(r.module for r in steps.collect()) == ["A.B", "quiet"]
    assert [(r.module, r.code) for r in spark.read.json(str(tmp_path / "failed")).collect()] == [("fails", 3)]
    for n in ("Mathlib/A.lean", "Mathlib/fails.lean"):
        put(tmp_path / "tree" / n, "x")
    pieces = tokens.public_path("piece_bpe_32k.model")
    rows = command_line.run(spark, ["steps", "--modules", str(tmp_path / "tree"), "--command", str(program), "{}", "--out", str(tmp_path / "out"), "--pieces", pieces]).collect()
    assert sum(r["rows"] for r in rows) == 2


def test_json_readers(spark, tmp_path):
    put(tmp_path / "t/2022-12-06_thys_A.thy_output.json", json.dumps({"translations": [["", "lemma x"]], "more": 1}))
    put(tmp_path / "t/b.thy_output.json", json.dumps({"other": []}))
    put(tmp_path / "t/c.json", json.dumps({"translations": []}))
    assert [(r.theory, r.translations) for r in readers.proof_traces(spark, str(tmp_path / "t")).collect()] == [("A", [["", "lemma x"]])]
    put(tmp_path / "h/a.json", json.dumps([["n", "lemma q: x"], ["n"], ["n", ""]]))
    held = readers.held_out_statements(spark, str(tmp_path / "h"))
    assert [r.statement for r in held.collect()] == ["lemma q: x"]
    assert [r.name for r in decontam.statement_names(held).collect()] == ["lemma q:"]
    for k, names in enumerate(([("f", "A.b"), ("g", "c.d")], [("f", "E.f")])):
        put(tmp_path / f"n{k}.json", json.dumps([{"file_path": f, "full_name": n} for f, n in names]))
    rows = decontam.one_per_file(readers.held_out_names(spark, [str(tmp_path / f"n{k}.json") for k in range(2)])).orderBy("rank").collect()
    assert [(r.file, r["name"]) for r in rows] == [("f", "E.f"), ("g", "c.d")]


def test_lines_keep_their_numbers(spark, tmp_path):
    for n in (1, 3, 5000):
        put(tmp_path / f"in/f{n}.jsonl", "\n".join(f'{{"k": {k}}}' for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5004 and all(json.loads(r.value)["k"] == r.pos for r in rows)


def test_modules(spark, tmp_path):
    for n in ("Mathlib/B/C.lean", "Mathlib/A.lean", "Other/D.lean"):
        put(tmp_path / n, "x")
    assert [r.module for r in readers.module_names(spark, str(tmp_path), "Mathlib").collect()] == ["Mathlib.A", "Mathlib.B.C"]
    assert readers.module_names(spark, str(tmp_path), "Mathlib", 1).count() == 1


@pytest.mark.parametrize("n", [0, 1, 10, 11])
def test_shards_hold_every_row(spark, tmp_path, n):
    df = spark.range(n).select(F.lit("é\U0001F600").alias("text"), F.struct("id", F.lit(None).cast("string").alias("none")).alias("meta"))
    sinks.write_shards(df.coalesce(1), str(tmp_path / "out"), rows=5)
    files = sorted((tmp_path / "out").glob("part-*"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert len(lines) == n and len(files) == max(1 if n else len(files), -(-n // 5))
    assert all(line.isascii() and json.loads(line)["text"] == "é\U0001F600" and "none" in json.loads(line)["meta"] for line in lines)


def test_shards_have_names_in_order(spark, tmp_path):
    df = spark.range(23).select(F.col("id").cast("string").alias("text"), F.when(F.col("id") < 20, "train").otherwise("test").alias("split"))
    sinks.write_splits(df.coalesce(1), str(tmp_path / "out"), rows=8, stem="lean")
    assert sorted(str(f.relative_to(tmp_path / "out")) for f in (tmp_path / "out").glob("*/*.jsonl")) == ["split=test/lean0000.jsonl", "split=train/lean0000.jsonl", "split=train/lean0001.jsonl", "split=train/lean0002.jsonl"]
    assert [len(f.read_text().splitlines()) for f in sorted((tmp_path / "out/split=train").glob("*.jsonl"))] == [8, 8, 4]
    assert spark.read.json(str(tmp_path / "out")).count() == 23


def test_shards_are_full_whatever_the_tasks(spark, tmp_path):
    """Rows of uneven tasks make full shards in the rows' order; digits follow the number of shards."""
    rows = [(f"{k:06}", "train" if k % 7 else "test") for k in range(3500)]
    df = spark.createDataFrame(rows, "text string, split string").repartitionByRange(5, "text").sortWithinPartitions("text").where("text < '000100' OR text > '000300'")
    sinks.write_splits(df, str(tmp_path / "out"), rows=500, stem="x")
    files = sorted((tmp_path / "out/split=train").glob("*.jsonl"))
    want = [t for t, s in rows if s == "train" and not "000100" <= t <= "000300"]
    assert [f.name for f in files] == [f"x{k:04}.jsonl" for k in range(-(-len(want) // 500))]
    assert [json.loads(line)["text"] for f in files for line in f.read_text().splitlines()] == want
    assert [sinks.shard_name("x", 7, n, 2) for n in (0, 19_997, 19_998)] == ["x0007.jsonl", "x0007.jsonl", "x00007.jsonl"]
    sizes = [len(f.read_text().splitlines()) for f in sorted((tmp_path / "out/split=train").glob("*.jsonl"))]
    assert set(sizes[:-1]) == {500} and sum(sizes) == len(want) and len(list((tmp_path / "out").glob("**/_shard*"))) == 0


def test_stats_are_replaced_by_language(spark, tmp_path):
    for rows in ([("a", 1), ("b", 2)], [("b", 3)]):
        sinks.upsert_stats(spark.createDataFrame(rows, "lang string, files int"), str(tmp_path / "s"))
    assert {(r.lang, r.files) for r in spark.read.json(str(tmp_path / "s")).collect()} == {("a", 1), ("b", 3)}


def test_code_job(spark, tmp_path, counter):
    names = [c.split()[0] for c in readers.CODE_FILE.split(",")]
    for lang, contents in {"python": ["import numpy\n", "x = 1", "from scipy import a"], "tex": ["\\section{a}", "no"], "gap": ["a", "1"]}.items():
        rows = [{"hexsha": f"{lang}{k}", "size": len(c), "ext": "tex", "max_stars_repo_path": "p", "max_stars_repo_name": f"r{k % 2}", "content": c} for k, c in enumerate(contents)]
        spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], readers.CODE_FILE).write.parquet(str(tmp_path / f"in/data/{lang}"))
    got = {r.lang: (r.files, r.size, r.num_tokens) for r in jobs.code_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), counter, ("python", "tex", "gap"), english=F.lit(True)).collect()}
    assert got == {"python": (2, 32, 6), "tex": (1, 11, 1), "gap": (1, 1, 1)}
    rows = spark.read.json(str(tmp_path / "out/python")).collect()
    assert sorted(r.split for r in rows) == ["test", "validation"]
    assert {(r.text, r.meta.reason) for r in rows} == {("import numpy\n", "import numpy"), ("from scipy import a", "from scipy")}
    assert (tmp_path / "out/meta/python_index").exists() and "num_tokens" in rows[0].meta
    assert sorted(f.name for f in (tmp_path / "out/python").glob("split=*/*.jsonl")) == ["python0000.jsonl"] * 2
    with pytest.raises(ValueError, match="english"):
        jobs.code_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), counter, ("tex",))


def test_tex_job_by_a_language_model(spark, tmp_path, counter):
    """The job needs no column: it reads a model file, and classifies only what passes all other rules."""
    labelled = [{"text": "the words of this section are in the english language and there are more of them", "lang": "en"}, {"text": "la section est dans une autre langue et il y en a encore beaucoup", "lang": "fr"}]
    (tmp_path / "labelled.json").write_text("".join(json.dumps(r) + "\n" for r in labelled))
    command_line.run(spark, ["languages", "--labelled", str(tmp_path / "labelled.json"), "--out", str(tmp_path / "model")])
    names = [c.split()[0] for c in readers.CODE_FILE.split(",")]
    contents = ["\\section{a} there are the words of this", "\\section{a} il y en a dans une autre langue", "the words of this language without a section", None]
    rows = [{"hexsha": f"x{k}", "size": 9, "ext": "tex", "max_stars_repo_path": "p", "max_stars_repo_name": "r", "content": c} for k, c in enumerate(contents)]
    spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], readers.CODE_FILE).write.parquet(str(tmp_path / "in/data/tex"))
    got = jobs.code_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), counter, ("tex",), language_model=str(tmp_path / "model")).collect()
    assert [(r.lang, r.files) for r in got] == [("tex", 1)]
    assert [r.text for r in spark.read.json(str(tmp_path / "out/tex")).collect()] == contents[:1]
    model = language.read_model(spark, str(tmp_path / "model"))
    files = spark.read.parquet(str(tmp_path / "in/data/tex"))
    english = language.language_of(F.col("content"), model, spark) == "en"
    text = files.where(filters.tex(F.col("content"), F.col("ext"), F.col("max_stars_repo_path"), english))._jdf.queryExecution().executedPlan().toString()
    assert text.index("ArrowEvalPython") < text.index("gnuplot")  # the cheap rules are below the classifier


def test_language_model_against_brute_force(spark):
    from collections import Counter

    rows = [("en", "the one and the other"), ("fr", "l'un et l'autre été"), ("en", "ab"), ("de", "der eine\U0001f600 und"), (None, "zzzz"), ("fr", None)]
    model = language.LanguageModel(language.train(spark.createDataFrame(rows, "lang string, text string")).toArrow())
    counts = {x: Counter(t[i : i + 3] for y, t in rows if x == y and t for i in range(len(t) - 2)) for x in ("de", "en", "fr")}
    grams = len({g for c in counts.values() for g in c})

    def brute(t):
        if t is None or len(t) < 3:
            return None
        return min(counts, key=lambda x: (-sum(math.floor(1000 * math.log((counts[x][t[i : i + 3]] + 1) / (counts[x].total() + grams))) for i in range(len(t) - 2)), x))

    texts = ["the", "et l'", "\U0001f600 und", "", None, "ab", "qqqqq", "other été", "eine " * 50_000, "x"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    got = {r.k: r.x for r in df.select("k", language.language_of(F.col("t"), model, spark).alias("x")).collect()}
    assert got == {k: brute(t) for k, t in enumerate(texts)}
    none = language.LanguageModel(language.train(spark.createDataFrame([], "lang string, text string")).toArrow())
    assert [r.x for r in df.select(language.language_of(F.col("t"), none, spark).alias("x")).distinct().collect()] == [None]


def test_repository_job(spark, tmp_path, counter):
    files = {"one/a.lean": "theorem y : p\n\nlemma keep z", "one/b.lean": "lemma keep z", "two/c.lean": "no", "two/d.lean": "lemma keep z"}
    for n, c in files.items():
        put(tmp_path / "trees" / n, c)
    repos = spark.createDataFrame([("a", "one", "s", "x/one"), ("b", "two", "t", "x/two")], "author string, repo string, sha string, save_path string")
    needles = decontam.theorem_needles(spark.createDataFrame([("a.lean", "X.y", 0)], "file string, name string, rank long"))
    stats = jobs.repository_corpus(spark, str(tmp_path / "trees"), repos, "lean", str(tmp_path / "out"), counter, needles).collect()
    assert [(r.lang, r.num_repos, r.num_examples, r.num_tokens) for r in stats] == [("lean", 2, 2, 6)]  # copies fall to one, and what lost its theorem keeps two line ends
    assert {r.text for r in spark.read.json(str(tmp_path / "out/lean")).collect()} == {"\n\nlemma keep z", "lemma keep z"}


def test_proof_job(spark, tmp_path):
    put(tmp_path / "afp/2022-12-06_thys_A.thy_output.json", json.dumps({"translations": [["", "lemma x"], ["s", "p"], ["", "lemma held out"]]}))
    put(tmp_path / "std/b.thy_output.json", json.dumps({"translations": [["", "theorem y"]]}))
    put(tmp_path / "test/t.json", json.dumps([["n", "lemma held out"]]))
    got = jobs.proof_corpus(spark, [str(tmp_path / "afp"), str(tmp_path / "std")], str(tmp_path / "test"), str(tmp_path / "out")).collect()
    assert {(r.proof, r.metadata.file, r.metadata.length) for r in got} == {("[STATEMENT]\nlemma x\n[PROOF STATE]\ns\n[PROOF STEP]\np", "A", 1), ("[STATEMENT]\ntheorem y", None, 0)}


def test_step_and_line_jobs(spark, tmp_path, counter):
    steps = spark.range(2000).select(F.concat(F.lit("m"), "id").alias("module"), F.lit("a b").alias("text"))
    got = {r.split: (r.rows, r.tokens) for r in jobs.step_corpus(spark, steps, counter, str(tmp_path / "steps")).collect()}
    assert sum(n for n, _ in got.values()) == 2000 and got["train"][0] > 1950 and all(t == 2 * n for n, t in got.values())
    put(tmp_path / "in/a.jsonl", "\n".join(map(str, range(200))))
    put(tmp_path / "in/b.jsonl", "0\n")
    got = {r.split: r["count"] for r in jobs.line_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert got == {"train": 198, "validation": 1, "test": 2}
    assert (tmp_path / "out/split=test/name=b.jsonl").exists()


def test_command_line(spark, tmp_path):
    ranks = ["--ranks", tokens.public_path("byte_bpe_50k.tiktoken")]
    put(tmp_path / "steps.jsonl", "\n".join(json.dumps({"module": f"m{k}", "text": "a b"}) for k in range(50)))
    got = command_line.run(spark, ["steps", "--steps", str(tmp_path / "steps.jsonl"), "--out", str(tmp_path / "o1"), *ranks]).collect()
    assert sum(r.rows for r in got) == 50 and sum(r.tokens for r in got) == 100

    for n, c in {"one/a.lean": "theorem y : p\n\nlemma keep z", "two/c.lean": "lemma other", "old/d.lean": "lemma late"}.items():
        put(tmp_path / "trees" / n, c)
    repos = [{"author": "a", "repo": r, "lang": "lean", "stars": k, "created": day, "save_path": f"x/{r}"} for k, (r, day) in enumerate([("one", "2020-01-01"), ("two", "2020-01-02"), ("old", "2024-01-01")])]
    put(tmp_path / "repos.jsonl", "\n".join(map(json.dumps, repos)))
    put(tmp_path / "held.json", json.dumps([{"file_path": "a.lean", "full_name": "X.y"}]))
    args = ["repositories", "--trees", str(tmp_path / "trees"), "--repositories", str(tmp_path / "repos.jsonl"), "-l", "lean", "--lean-held-out", str(tmp_path / "held.json")]
    for k, weekly in enumerate(([], ["--weekly"])):
        out = str(tmp_path / f"o2{k}")
        got = command_line.run(spark, [*args, *weekly, "--out", out, *ranks]).collect()
        assert [(r.lang, r.num_repos, r.num_examples) for r in got] == [("lean", 2, 2)]
        rows = spark.read.json(f"{out}/lean").collect()
        assert {(r.text, r.meta.sha) for r in rows} == {("\n\nlemma keep z", "master"), ("lemma other", "master")}
    for wrong in (["code", "--root", "r", "--out", "o", "-l", "tex", *ranks], ["steps", "--steps", "s", "--out", "o"], []):
        with pytest.raises(SystemExit):
            command_line.run(spark, wrong)


def test_token_counters(spark):
    texts = ["hello world", "", None, "<|endoftext|>", "é😀"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    ranks, pieces = tokens.ranks_counter(tokens.public_path("byte_bpe_50k.tiktoken")), tokens.pieces_counter(tokens.public_path("piece_bpe_32k.model"))
    got = df.select("k", ranks("t").alias("a"), pieces("t").alias("b")).orderBy("k").collect()
    assert got[0].a == 2 and got[1].a == got[1].b == got[2].a == got[2].b == 0 and got[3].a > 1 and got[4].b > 0


def test_streams(spark, tmp_path):
    docs = spark.createDataFrame([("import numpy",), ("x",), ("from jax import y",)], "content string")
    docs.write.parquet(str(tmp_path / "in"))
    kept = feeds.kept_stream(feeds.document_stream(spark, str(tmp_path / "in"), "content string"), "python")
    feeds.write_stream(kept, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert {r.content for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"import numpy", "from jax import y"}
    feeds.write_stream(kept, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()  # a restart adds nothing
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "events"))
    weeks = feeds.weekly_counts(feeds.document_stream(spark, str(tmp_path / "events"), "ts timestamp, event_type string, value double"))
    feeds.write_stream(weeks, str(tmp_path / "weeks"), str(tmp_path / "state2")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "weeks")).agg(F.sum("n")).first()[0]
    assert 0 < got <= events.count()
