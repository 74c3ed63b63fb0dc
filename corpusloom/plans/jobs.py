"""The corpus jobs, each from local inputs to written documents, indexes and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import external
from corpusloom.functions.language import language_of, read_model
from corpusloom.functions.notebook import convert_notebooks
from corpusloom.operators import decontam, filters, splits, stats
from corpusloom.operators.dedup import chunk_dedup
from corpusloom.operators.segments import proofs
from corpusloom.session import stored
from corpusloom.sources import readers, sinks


def code_corpus(spark: SparkSession, root: str, out: str, counter, languages=tuple(filters.STACK_LANGUAGES), english: Column | None = None, seed: int = 74, language_model: str | None = None) -> DataFrame:
    """Re-filter code files language by language; returns the statistics.

    The kept rows are stored once, as statistics, split and index all read them. Of TeX, only files in English
    are kept: english is a column that tells so, or language_model a model file (functions/language.py) by which files that
    pass all other tests are judged. One of them is required if tex is among the languages.
    """
    if "tex" in languages and english is None:
        if language_model is None:
            raise ValueError("tex needs english, a column that tells whether a file is in English, or a language_model")
        english = F.coalesce(language_of(F.col("content"), read_model(spark, language_model), spark) == "en", F.lit(False))
    rows = []
    for lang in languages:
        spec = filters.STACK.get(lang)
        df = readers.code_files(spark, root, lang).withColumn("english", english if lang == "tex" else F.lit(True))
        df = df.where(spec.keep(F.col)).drop("english") if spec else df.drop("english")
        if lang == "python":
            df = df.withColumn("reason", filters.python_reason(F.col("content")))
        if spec and spec.converts:
            df = convert_notebooks(df).where("converted")
        df = stored(df.withColumn("num_tokens", counter(F.col("content"))), f"code-{lang}")
        sinks.write_splits(sinks.as_documents(splits.hash_split(df, "hexsha", seed)).select("text", "meta", F.col("meta.split").alias("split")).withColumn("meta", F.col("meta").dropFields("split")), f"{out}/{lang}", stem=lang)
        sinks.write_index(df, "max_stars_repo_name", f"{out}/meta/{lang}_index")
        rows.append(stats.corpus_stats(df.withColumn("lang", F.lit(lang)), "lang", size=F.col("size"), tokens=F.col("num_tokens")))
    total = rows[0]
    for r in rows[1:]:
        total = total.unionByName(r)
    sinks.upsert_stats(total, f"{out}/meta/stats")
    return total


def repository_corpus(spark: SparkSession, trees: str, repos: DataFrame, lang: str, out: str, counter, needles: DataFrame | None = None, names: DataFrame | None = None, chunk: int = 2048, ratio: float = splits.EVAL_RATIO, seed: int = 72) -> DataFrame:
    """Filter, decontaminate, de-duplicate, count and split the files of repositories; returns the statistics.

    needles and names are tables of what is held out of Lean and Isabelle. The order matters: files that removal makes equal collapse.
    """
    files = readers.extracted(spark, trees, filters.GITHUB_EXTENSIONS[lang], repos)
    kept = filters.keep_language(files, lang, filters.GITHUB).withColumn("key", F.concat_ws("/", "meta.author", "meta.repo", "meta.path"))
    if lang == "lean" and needles is not None:
        kept = decontam.without_theorems(kept, needles, "key", "text", "meta.path")
    elif lang == "isabelle" and names is not None:
        kept = decontam.without_statements(kept, names, "text")
    kept = stored(chunk_dedup(kept, "key", "text", chunk).withColumn("num_tokens", counter(F.col("text"))), f"files-{lang}")
    sinks.write_splits(splits.hash_split(kept, "key", seed, ratio).select("text", "meta", "split"), f"{out}/{lang}", stem=lang)
    sinks.write_index(repos.withColumn("name", F.concat_ws("/", "author", "repo")), "name", f"{out}/meta/github_{lang}_index")
    repos.write.mode("overwrite").json(f"{out}/meta/{lang}-repos")
    found = kept.agg(F.count("*").alias("num_examples"), F.sum("num_tokens").alias("num_tokens"))
    total = found.select(F.lit(repos.count()).cast("bigint").alias("num_repos"), "num_examples", "num_tokens", F.lit(lang).alias("lang"))
    sinks.upsert_stats(total, f"{out}/meta/github-stats")
    return total


def proof_corpus(spark: SparkSession, folders: list[str], held_out: str | None, out: str) -> DataFrame:
    """Proofs of several trace folders, less those that contain a held-out statement; returns what it wrote."""
    rows = None
    for f in folders:
        part = readers.proof_traces(spark, f).select("theory", F.col("theory").alias("file"), "translations")
        rows = part if rows is None else rows.unionByName(part)
    found = proofs(rows)
    if held_out:
        found = decontam.without_containing(found, readers.held_out_statements(spark, held_out), "proof", "statement")
    result = found.select("proof", F.struct("file", "length").alias("metadata"))
    sinks.write_shards(result, out)
    return spark.read.schema(result.schema).json(out)


def extracted_steps(modules: DataFrame, out: str, command: list[str], cwd: str | None = None, seconds: float = external.SECONDS) -> DataFrame:
    """(module, text) of what a program prints for each module; the modules that it fails for are written to out with the error.

    The results are stored before they are divided, so no module is run twice.
    """
    made = stored(external.through_program(modules, "module", command, cwd, seconds=seconds), "steps")
    made.where("error IS NOT NULL").select("module", "code", "error").write.mode("overwrite").json(out)
    return made.where("error IS NULL").select("module", "text")


def step_corpus(spark: SparkSession, steps: DataFrame, counter, out: str, seed: int = 7) -> DataFrame:
    """Training text of modules (module, text), each drawn to a split by itself; returns the split sizes."""
    rows = steps.select("text", F.struct(F.col("module").alias("mathlib_filename"), counter(F.col("text")).alias("llama_tokens")).alias("meta"), "module")
    drawn = stored(splits.bernoulli_split(rows, "module", seed).drop("module"), "steps")
    sinks.write_splits(drawn, out)
    return drawn.groupBy("split").agg(F.count("*").alias("rows"), F.sum("meta.llama_tokens").alias("tokens"))


def line_corpus(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Split each file of lines by place, 99 % to train; lines are not parsed. Returns counts by split."""
    lines = stored(readers.numbered_lines(spark, path), "lines")
    split = stored(splits.positional_split(lines, "file", "pos"), "lines-split")
    split.select("value", F.regexp_extract("file", "([^/]+)$", 1).alias("name"), "split").write.mode("overwrite").partitionBy("split", "name").text(out)
    return split.groupBy("split").count()
