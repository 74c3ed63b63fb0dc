"""Boundary cases of the operators, on small rows."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import notebook, text
from corpusloom.operators import catalog, decontam, dedup, filters, segments, splits, stats, substrings
from corpusloom.operators.running import running_sum
from corpusloom.session import scratch_root, settled, spread, stored


def values(spark, texts, *columns):
    rows = [(k, t) for k, t in enumerate(texts)]
    return [tuple(r) for r in spark.createDataFrame(rows, "k int, t string").orderBy("k").select(*columns).collect()]


def flags(spark, texts, rule):
    return [r[0] for r in values(spark, texts, rule(F.col("t")))]


def test_standard_filter(spark):
    long = "é" * 524_287  # 1 048 574 bytes
    texts = [long + "a", long + "aa", "1a", "11a", "", " \x1c  ", "٣٣", "1 1 a a"]
    assert flags(spark, texts, filters.standard) == [True, False, True, False, False, False, True, True]
    assert flags(spark, texts, lambda t: filters.standard(t, blank=True))[4:6] == [True, True]


@pytest.mark.parametrize("rule, keep, drop", [
    (filters.r, ["x <- 1", " <?xml", " {"], ["a /* Resource fork", "Requirement {\n Identifier", "<?xml", "{a"]),
    (filters.maple, ["a" * 100_000], ["a" * 100_001, "<?xml"]),
    (filters.haskell, ["import Statistics", "import  qualified   Data.Complex", "import NumericXLinearAlgebra"], ["Statistics", "import Data.List"]),
    (filters.python, ["import numpy\nfrom scipy", "import sagemaker"], ["  {import numpy", "x = 1", ""]),
    (filters.c, ["#include <fftw3.h>", "#include <gsl/a.h>"], ["#include <stdio.h>"]),
    (lambda t: filters.c(t, fused=True), ["#include <gsl"], ["#include <fftw3.h>"]),
    (filters.cpp, ["#include <Eigen/a>" + "a" * 10], ["#include <vector>", "#include <Eigen" + "1" * 40]),
    (filters.coq, ["Theorem a"], ["Theorem wire", "Proof endmodule", "Qed This file was automatically generated", "none"]),
    (filters.matlab, ["x", " main(void){\nx", " main(void){\r", ""], ["#include", "#import", " main(void){", "a main(x) {\n"]),
    (filters.notebook, ["IMPORT SYMPY", "\\begin{align}"], ["import numpy"]),
    (filters.generated, [".a", "x-generated"], ["a.b"]),
])
def test_rules(spark, rule, keep, drop):
    assert flags(spark, keep + drop, rule) == [True] * len(keep) + [False] * len(drop)


def test_python_reason(spark):
    assert flags(spark, ["from scipy\nimport numpy", " {", "x", "1"], filters.python_reason) == ["import numpy,from scipy", "notebook", "not found", "standard"]


def test_julia(spark):
    small = lambda t: filters.julia(t, F.lit(99_999))
    large = lambda t: filters.julia(t, F.lit(100_000))
    assert flags(spark, ["%a", "{", "[", "", "a", " "], small) == [False, False, False, False, True, True]
    assert flags(spark, ["@test a" + "\n" * 9, "@test a" + "\n" * 10, "a", "@test 1" + "1" * 20], large) == [True, False, False, False]
    assert flags(spark, ["sin x", " sin x", "ésiné", " π "], lambda t: filters.julia_strict(t, F.lit(1))) == [False, True, False, True]


def test_tex_lean_isabelle(spark):
    rows = [("\\section{a}", "tex", "a.tex"), ("\\section{a}", "sty", "a.sty"), ("\\section{a}", "tex", "latex/a.tex"), ("\\section{gnuplot}", "tex", "a"), ("\\paragraph*{a}", "tex", "a")]
    df = spark.createDataFrame(rows, "t string, ext string, path string")
    assert [r[0] for r in df.select(filters.tex(F.col("t"), F.col("ext"), F.col("path"), F.lit(True))).collect()] == [True, False, False, False, False]
    rows = [("lemma a", "m", "a"), ("lemma", "m", "a"), ("lemma a", "miniF2F", "a"), ("lemma a", "miniF2F-extra", "a"), ("lemma a", "m", "_target/deps/a")]
    df = spark.createDataFrame(rows, "t string, repo string, path string")
    assert [r[0] for r in df.select(filters.lean(F.col("t"), F.col("repo"), F.col("path"))).collect()] == [True, False, False, True, False]
    rows = [("lemma a", "mirror-afp-2021"), ("lemma a", "mirror-afp-devel"), ("theorem a", "x-mirror-afp-2021"), ("a", "b")]
    df = spark.createDataFrame(rows, "t string, repo string")
    assert [r[0] for r in df.select(filters.isabelle(F.col("t"), F.col("repo"))).collect()] == [False, True, True, False]


def test_registry(spark):
    assert set(filters.STACK) == set(filters.STACK_LANGUAGES) and set(filters.GITHUB) == set(filters.GITHUB_EXTENSIONS)
    df = spark.createDataFrame([("11",), ("a",)], "content string")
    assert filters.keep_language(df, "gap").count() == 1 and filters.keep_language(df, "unknown").count() == 2


def test_without_part(spark):
    texts = ["abc", "QxN tail", "a Q rest", "Q1N Q2N", "aQ"]
    cut, had = text.without_part(F.col("t"), F.lit("Q"), "N")
    assert values(spark, texts, cut, had) == [("abc", False), ("N tail", True), ("a ", True), ("N Q2N", True), ("a", True)]


def test_markup(spark):
    texts = ['a ![x](y "z") b', "![a](b)c", "<script>\nx</script>y", "<img src=a>b", "<video a>\n</video><iframe></iframe>c", "<SCRIPT></SCRIPT>"]
    assert flags(spark, texts, notebook.stripped) == ["a  b", "c", "y", "b", "c", "<SCRIPT></SCRIPT>"]


def test_names(spark):
    assert flags(spark, ["x/2022-12-06_thys_A_B.thy_output.json.thy_output.json", "thys_A"], text.theory_of) == ["A_B", None]
    assert flags(spark, ["Mathlib/A/B.lean"], text.module_name) == ["Mathlib.A.B"]


def brute_dedup(docs, size):
    seen, kept = set(), []
    for k, t in sorted(docs):
        chunks = [t[i : i + size] for i in range(0, len(t), size)]
        whole = [c for c in chunks if len(c) == size or len(chunks) == 1]
        dup = False
        for c in whole:
            dup |= c in seen
            seen.add(c)
        if not dup:
            kept.append(k)
    return kept


def test_chunk_dedup(spark):
    a, b = "a" * 8, "bcdefghi"
    texts = ["x", "x", a + b, "z" + a + b, b + b, b + "tail", "12345678tail", "87654321tail", "", "", "abcdefg", "abcdefgh", "abcdefghi", "abcdefgh", a + "u", "u", "😀" * 8, "😀" * 9]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(r[0] for r in dedup.chunk_dedup(df, size=8).collect()) == brute_dedup(docs, 8)
    self_repeat = spark.createDataFrame([(1, "ab" * 8)], "doc_id long, text string")
    assert dedup.chunk_dedup(self_repeat, size=8).count() == 0 and dedup.chunk_dedup(self_repeat, size=8, within=False).count() == 1


def brute_lean(docs, theorems):
    last = {}
    for f, n in theorems:
        last[f] = n
    out = []
    for t, path in docs:
        was = False
        for f, n in last.items():
            parts = n.split(".")
            for word in ("theorem ", "lemma ") if f in path else ():
                for k in range(1, len(parts)):
                    needle = word + ".".join(parts[-k:]) + " "
                    if needle in t:
                        at = t.index(needle)
                        stop = t.find("\n\n", at)
                        t, was = t[:at] + (t[stop:] if stop >= 0 else ""), True
                        break
        out.append((t, was))
    return out


def test_lean_removal(spark):
    theorems = [("a.lean", "Old.name"), ("b.lean", "B.C.d"), ("a.lean", "N.x.y"), ("c.lean", "one"), ("", "Z.all")]
    docs = [("theorem y : p\n\nlemma x.y : q", "src/a.lean"), ("theorem name : p", "a.lean"), ("lemma C.d :\n\nlemma d : r\n\nkeep theorem C.d ", "b.lean"), ("theorem one : p", "c.lean"), ("theorem all : t", "q"), ("theorem B.C.d : whole", "b.lean"), ("", "a.lean")]
    names = spark.createDataFrame([(f, n, k) for k, (f, n) in enumerate(theorems)], "file string, name string, rank long")
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "id long, text string, path string")
    got = decontam.without_theorems(df, decontam.theorem_needles(decontam.one_per_file(names)), "id", "text", "path").orderBy("id").collect()
    assert [(r.text, r.was_transformed) for r in got] == brute_lean(docs, theorems)
    strict = decontam.without_theorems(df, decontam.theorem_needles(names, strict=True), "id", "text", "path").orderBy("id").collect()
    assert strict[3].was_transformed and strict[5].text == "" and strict[1].was_transformed


def test_isabelle_removal(spark):
    df = spark.createDataFrame([("lemma a: theorem b: x\n\ny",), ("theorem b: lemma a: z",), ("c",)], "text string")
    got = decontam.without_statements(df, ["theorem b:", "lemma a:", ""], "text").collect()
    assert [tuple(r) for r in got] == [("\n\ny", True), ("", True), ("c", False)]
    assert [tuple(r) for r in decontam.without_statements(df, [], "text").collect()][2] == ("c", False)


def test_without_containing(spark):
    df = spark.createDataFrame([("has Statement in",), ("has statement",), ("x",)], "text string")
    held = spark.createDataFrame([("Statement",), ("",)], "text string")
    assert sorted(r[0] for r in decontam.without_containing(df, held).collect()) == ["has statement", "x"]


def test_without_containing_equals_search(spark):
    rng = random.Random(5)
    words = ["a", "b", "ab", "", "c\nd", "é", "a.b"]
    def some(least, most):
        return " ".join(rng.choices(words, k=rng.randint(least, most)))
    long = [some(6, 9) for _ in range(40)] + ["b a b a b a b a b", "x y z v w u"]
    texts = [some(0, 60) for _ in range(300)] + [some(0, 9) + n + some(0, 9) for n in long] + ["qx y z v w uq", "x y z v w", None, "", "", long[0], long[0]]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(5)
    for held in (long, [*long, "é é é", "c\nd", ""], ["é é é"], [""], [None, "x y z v w u"], []):
        rows = spark.createDataFrame([(h,) for h in held], "s string")
        expected = [k for k, t in enumerate(texts) if t is None or not any(h in t for h in held if h)]
        assert sorted(r.k for r in decontam.without_containing(docs, rows, "t", "s").collect()) == expected


@pytest.fixture(params=["automaton", "anchors"])
def either(request, monkeypatch):
    """Few strings and very many go different ways."""
    if request.param == "anchors":
        monkeypatch.setattr(substrings, "AUTOMATON_BYTES", 0)


def test_occurrences(spark, either):
    rng = random.Random(11)
    some = lambda least, most: "".join(rng.choices("aab\u00e9\n\U0001f600 ", k=rng.randint(least, most)))
    needles = {some(0, 9) for _ in range(60)} | {some(60, 70) for _ in range(5)} | {"", "a", "\u00e9", "b" * 64, "never there"}
    texts = {some(0, 80) + n + some(0, 3) for n in sorted(needles) for _ in range(3)} | {""}
    rows = spark.createDataFrame([(t,) for t in [*sorted(texts), None]], "t string").repartition(4)
    held = spark.createDataFrame([(n,) for n in [*sorted(needles), None, "a"]], "n string")
    got = sorted(map(tuple, substrings.occurrences(rows, "t", held, "n").collect()))
    assert got == sorted((t, n) for t in texts for n in needles if n in t)
    assert substrings.occurrences(rows, "t", held.where("false"), "n").count() == 0


def test_removal_folds_hits_only(spark, either):
    """As the fold of every name in order, also where a cut puts a name together; names come from a table."""
    rng = random.Random(4)
    pieces = ["lemma a:", "b:", "\n\n", "x", "thm\n\nq:", "thm", "q:", "\n", "z\n", "lemma a", ":", "\u00e9:"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(400)] + [None, ""]
    names = ["lemma a:", "b:", "thm\n\nq:", "\u00e9:", "z\n", "absent:", "", None] + [f"name {k}:" for k in range(300)]

    def fold(t):
        was = False
        for n in sorted({n for n in names if n}):
            if t is not None and n in t:
                at = t.index(n)
                stop = t.find("\n\n", at)
                t, was = t[:at] + (t[stop:] if stop >= 0 else ""), True
        return t, was

    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    held = spark.createDataFrame([(n,) for n in names], "stated string")
    got = {r.k: (r.text, r.was_transformed) for r in decontam.without_statements(df, held, "text", name="stated").collect()}
    assert got == {k: fold(t) for k, t in enumerate(texts)}


def test_lean_removal_by_parts_of_paths(spark, either):
    """Files that are no whole components of a path; paths that are null or repeat."""
    theorems = [("b/c.le", "N.x.y"), ("c.lean", "M.z"), ("/", "A.w"), ("nowhere", "Q.y")]
    docs = [("theorem y \n\nlemma z :", "a/b/c.lean"), ("lemma z \n\ntheorem w ", "xc.lean"), ("theorem w ", "a/b"), ("theorem y ", "ab/c.le"), ("theorem y ", None), (None, "a/b/c.lean"), ("theorem x.y ", "a/b/c.lean")]
    names = spark.createDataFrame([(f, n, k) for k, (f, n) in enumerate(theorems)], "file string, name string, rank long")
    df = spark.createDataFrame([(k, *d) for k, d in enumerate(docs)], "id long, text string, path string")
    got = decontam.without_theorems(df, decontam.theorem_needles(names), "id", "text", "path").orderBy("id")
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    some = [k for k, (t, p) in enumerate(docs) if t is not None and p is not None]
    rows = got.collect()
    assert [(rows[k].text, rows[k].was_transformed) for k in some] == brute_lean([docs[k] for k in some], theorems)
    assert (rows[4].text, rows[4].was_transformed, rows[5].text, rows[5].was_transformed) == ("theorem y ", False, None, False)


def test_antijoin_of_short_statements_has_no_product(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "xyz"), (3, None), (4, "")], "k int, t string")
    held = spark.createDataFrame([("b",), ("q r",), ("\u00e9",)], "s string")
    kept = decontam.without_containing(df, held, "t", "s")
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and sorted(r.k for r in kept.collect()) == [2, 3, 4]


def test_bloom_filter_has_all_members(spark):
    df = spark.range(50_000).select(F.xxhash64("id").alias("h"))
    bloom = substrings.bloom_of(df, "h")
    members = np.array([r.h for r in df.collect()], np.int64).view(np.uint64)
    others = np.array([r.h for r in spark.range(50_000, 150_000).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
    assert bloom.may_have(members).all() and bloom.may_have(others).mean() < 0.02


def test_segments(spark):
    traces = [("a", [["", "lemma x"], ["s", "p"], ["", "theorem y"], ["", "def z"], ["t", "q"]]), ("b", []), ("c", [["s", "lemma lead"], ["", "lemmaless"]]), ("d", None), ("e", [["", "lemma only"]])]
    df = spark.createDataFrame(traces, "file string, translations array<array<string>>")
    got = [(r.file, r.proof, r.length) for r in segments.proofs(df).orderBy("file", "position").collect()]
    assert got == [
        ("a", "[STATEMENT]\nlemma x\n[PROOF STATE]\ns\n[PROOF STEP]\np", 1), ("a", "[STATEMENT]\ntheorem y", 0), ("c", "[STATEMENT]\nlemma lead", 0), ("e", "[STATEMENT]\nlemma only", 0),
    ]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 199, 200, 399, 400, 1000])
def test_hash_split_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = {r["split"]: r["count"] for r in splits.hash_split(df, "k").groupBy("split").count().collect()}
    t = max(int(0.005 * n), 1)
    want = {"test": min(n, t), "validation": max(0, min(n - t, t)), "train": max(0, n - 2 * t)}
    assert got == {k: v for k, v in want.items() if v}
    if n == 400:
        again = splits.hash_split(df.repartition(7), "k")
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, splits.hash_split(df, "k").collect()))


def test_positional_split(spark):
    sizes = [1, 2, 99, 100, 101, 200, 1000]
    df = spark.createDataFrame([(f"f{n}", k) for n in sizes for k in range(n)], "file string, pos long").repartition(5)
    got = {}
    for r in splits.positional_split(df, "file", "pos").collect():
        got.setdefault(r.file, {}).setdefault(r.split, []).append(r.pos)
    for n in sizes:
        train = n * 99 // 100
        validation = (n - train) // 2
        want = {"train": range(train), "validation": range(train, train + validation), "test": range(train + validation, n)}
        assert {k: sorted(v) for k, v in got[f"f{n}"].items()} == {k: list(v) for k, v in want.items() if len(v)}


def test_running_sum(spark):
    rows = [(None if k % 50 == 0 else "hot" if k % 3 else f"g{k % 7}", (k * 37) % 1000, k % 5) for k in range(1000)]
    got = {(r.g, r.at): r.total for r in running_sum(spark.createDataFrame(rows, "g string, at long, v long"), "g", "at", F.col("v"), "total", ranges=8).collect()}
    assert got == {(g, at): sum(v2 for g2, at2, v2 in rows if g2 == g and at2 <= at) for g, at, _ in rows}


def test_weeks(spark):
    rows = [tuple(map(str, r)) for r in catalog.week_intervals(spark, "2024-01-01", "2024-01-10").collect()]
    assert rows == [("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-10")]
    assert [tuple(map(str, r)) for r in catalog.week_intervals(spark, "2024-01-01", "2024-01-01").collect()] == [("2024-01-01", "2024-01-01")]
    with pytest.raises(ValueError):
        catalog.week_intervals(spark, "2024-01-02", "2024-01-01")
    repos = spark.createDataFrame([("a", "r", "coq", 5, "2024-01-08"), ("b", "s", "coq", 9, "2024-01-09"), ("c", "t", "coq", 7, "2024-01-01"), ("d", "u", "lean", 7, "2024-01-01")], "author string, repo string, lang string, stars long, created string")
    got = catalog.repos_by_week(repos, "coq", "2024-01-01", "2024-01-10", 10).collect()
    assert [(r.author, str(r.left)) for r in got] == [("c", "2024-01-01"), ("a", "2024-01-01"), ("b", "2024-01-08"), ("a", "2024-01-08")]
    assert [r.author for r in catalog.repos_by_week(repos, "coq", "2024-01-01", "2024-01-10", 10, distinct=True).collect()] == ["c", "a", "b"]
    assert [r.author for r in catalog.top_repos(repos, "coq", 2).collect()] == ["b", "c"]


def test_commits_as_of(spark):
    repos = spark.createDataFrame([("a", "r"), ("b", "s"), ("c", "t")], "author string, repo string")
    commits = spark.createDataFrame([("a", "r", "1", "2023-01-01"), ("a", "r", "2", "2023-04-01"), ("a", "r", "3", "2023-04-02"), ("b", "s", "4", "2024-01-01"), ("c", "t", "5", "2023-01-01"), ("c", "t", "6", "2023-01-01")], "author string, repo string, sha string, at string").select("author", "repo", "sha", F.to_timestamp("at").alias("committed"))
    got = {r.author: r.sha for r in catalog.latest_as_of(repos, commits, "2023-04-01").collect()}
    assert got == {"a": "2", "b": "master", "c": "6"}
    assert {r.author: r.sha for r in catalog.latest_as_of(repos, commits, None).collect()} == {"a": "3", "b": "4", "c": "6"}


def book(*cells):
    return json.dumps({"cells": list(cells), "metadata": {"kernelspec": {}}, "nbformat": 4})


def test_notebooks(spark):
    png = {"output_type": "display_data", "data": {"image/png": "xyz"}}
    plain = {"output_type": "execute_result", "data": {"text/plain": ["4", "2"], "image/png": ""}}
    error = {"output_type": "error", "ename": "E", "traceback": []}
    code = lambda *out: {"cell_type": "code", "source": ["x = 1\n", "y"], "outputs": list(out)}
    texts = [book({"cell_type": "markdown", "source": "# T ![a](b)<img c>"}, code(plain)), book(code(plain, png)), book(code({"output_type": "stream", "text": "s\nt\n"}, error)), "not json", "[1]", None, json.dumps({"cells": [{}]}), json.dumps({"worksheets": [{"cells": [{"cell_type": "heading", "level": 2, "source": "h"}, {"cell_type": "code", "input": "z", "outputs": []}]}]})]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, content string")
    got = [(r.converted, r.content) for r in notebook.convert_notebooks(df).orderBy("k").collect()]
    fence = "```python\nx = 1\ny\n```"
    assert got[0] == (True, f"# T \n\n{fence}\n\n    42\n") and got[1] == got[2] == (True, f"{fence}\n")
    assert got[3] == (False, "not json") and [g[0] for g in got[3:7]] == [False] * 4 and got[7] == (True, "## h\n\n```\nz\n```\n")


def test_notebooks_in_the_jvm_follow_the_rules_of_the_python_function(spark):
    """Random notebooks, with parts missing or of the wrong kind, through both."""
    rng = random.Random(8)
    line = lambda: rng.choice(["x = 1", "", "a\n", "\n\n", "é \U0001f600", "end\n\n"])
    some_text = lambda: rng.choice([line(), [line(), line()], [], None, line()])

    def output():
        kinds = rng.choice(["stream", "execute_result", "display_data", "error"])
        out = {"output_type": kinds}
        if kinds == "stream":
            out["text"] = some_text()
        elif kinds == "error" and rng.random() < 0.3:
            out |= {"ename": "E", "traceback": []}
        else:
            out["data"] = {k: some_text() for k in rng.sample(["text/plain", "text/markdown", "text/latex", "application/json"], rng.randrange(3))}
            if rng.random() < 0.2:
                out["data"]["image/png"] = rng.choice(["", "abc"])
        return out

    def cell(old):
        made = {"cell_type": rng.choice(["code", "code", "markdown", "raw", "heading"]), ("input" if old and rng.random() < 0.5 else "source"): some_text()}
        if made["cell_type"] == "code":
            made["outputs"] = [output() for _ in range(rng.randrange(4))]
            if old and made["outputs"] and rng.random() < 0.3:
                made["outputs"][0] = {"output_type": "pyout", "text": ["1\n", "2"], **({"png": "q"} if rng.random() < 0.3 else {})}
        if made["cell_type"] == "heading":
            made["level"] = rng.randrange(1, 4)
        if rng.random() < 0.03:
            made.pop(rng.choice(list(made)))
        return made

    def whole():
        meta = rng.choice([{}, {"language_info": {"name": "julia"}}, {"kernelspec": {}}, {"language_info": {}, "kernelspec": {"name": "p"}}])
        if rng.random() < 0.3:
            return {"worksheets": [{"cells": [cell(True) for _ in range(rng.randrange(4))]} for _ in range(rng.randrange(3))], "metadata": meta, "nbformat": 3}
        return {"cells": [cell(False) for _ in range(rng.randrange(5))], "metadata": meta}

    texts = [json.dumps(whole()) for _ in range(500)] + ['{"cells": 5}', '{"cells": [5]}', "5", "null", "", None, '{"cells": [{"cell_type": "raw", "source": 7}]}']
    strict = spark.createDataFrame(list(enumerate(texts)), "k int, content string")
    got = {r.k: r.m for r in strict.select("k", notebook.to_markdown(F.col("content")).alias("m")).collect()}
    assert {k: got[k] for k in got} == {k: notebook.markdown_of(t) for k, t in enumerate(texts)}
    loose = ['{"cells": [{"cell_type": "code", "source": "a", "outputs": [{"output_type": "display_data", "data": {"application/x": NaN, "text/plain": "1"}}]}]}', '{"cells": [], "cells": [{"cell_type": "raw", "source": "twice"}]}']
    rows = notebook.convert_notebooks(spark.createDataFrame([(t,) for t in loose], "content string")).collect()
    assert [tuple(r) for r in rows] == [("```\na\n```\n\n    1\n", True), ("twice\n", True)]


def test_pager_with_ties_and_a_changing_table(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), k) for k in range(60)]
    df = spark.createDataFrame(rows, "x int, y string, k int").repartition(1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    pager, seen = stats.Pager(df, "x", "y"), []
    while page := pager.head(7):
        seen += map(tuple, page)
    assert [order(r) for r in seen] == sorted(map(order, rows)) and sorted(seen, key=str) == sorted(rows, key=str)
    assert [order(r) for r in pager.tail(25) + pager.tail(40)] == sorted(map(order, rows), reverse=True)
    numbers = spark.range(10, 20).toDF("k")
    pager = stats.Pager(numbers, "k")
    assert [r.k for r in pager.head(3)] == [10, 11, 12]
    pager.df = numbers.union(spark.range(5).toDF("k"))  # rows before the cursor come too late and shift nothing
    assert [r.k for r in pager.head(3)] == [13, 14, 15]


def test_python_rule_is_the_reason_that_names_keywords(spark):
    rng = random.Random(6)
    pieces = ["import numpy", "from scipy", "{", "1 2 3 4 5 6", " ", "\n", "\u00a0", "x = a", "import os", "\u0663"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(6))) for _ in range(400)] + ["", "import numpy" + "9" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = df.select(filters.python(t).alias("kept"), filters.python_reason(t).alias("why")).collect()
    assert all(r.kept == (r.why not in ("standard", "notebook", "not found")) for r in rows) and 20 < sum(r.kept for r in rows) < 390


def test_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(100).repartition(9).write.parquet(f"{tmp_path}/many")
    plans = [spread(spark.read.parquet(f"{tmp_path}/{x}"))._jdf.queryExecution().executedPlan().toString() for x in ("one", "many")]
    assert ["Exchange" in p for p in plans] == [True, False]


def test_settled_keeps_the_result_only(spark):
    names = lambda: {f.getPath().getName().rsplit("-", 1)[0] for f in fs.listStatus(folder)}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    outside = stored(spark.range(3), "settled-outside")

    def make():
        inner = settled(spark, "settled-inner", lambda: stored(outside, "settled-deepest").where("id > 0"))
        assert "settled-inner" in names() and "settled-deepest" not in names()
        return stored(inner, "settled-more").union(inner)

    result = settled(spark, "settled-result", make)
    assert sorted(r.id for r in result.collect()) == [1, 1, 2, 2]
    assert {n for n in names() if n.startswith("settled")} == {"settled-outside", "settled-result"}
    with pytest.raises(ZeroDivisionError):
        settled(spark, "settled-not", lambda: 1 / 0)


def test_stats_views(spark):
    df = spark.createDataFrame([(k, "a" * (k % 5), "x" if k % 2 else None) for k in range(10)], "k int, t string, repo string")
    pager = stats.Pager(df, "k")
    assert [r.k for r in pager.head(2) + pager.head()] == [0, 1, 2] and [r.k for r in pager.tail(2)] == [9, 8]
    assert [r.k for r in stats.longest(df, "t", "k", 3).collect()] == [4, 9, 3]
    assert stats.index_of(df, "repo").count() == 1
    assert [r.k for r in stats.shuffled(df, "k", 1).collect()] == [r.k for r in stats.shuffled(df.repartition(3), "k", 1).collect()]


def test_whitespace_class(spark):
    spaces = [chr(p) for p in range(0x110000) if chr(p).isspace()]
    assert flags(spark, ["".join(spaces), "a​b"], text.solid_length) == [0, 3] and re.fullmatch(r"\s+", "".join(spaces))
