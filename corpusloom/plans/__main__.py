"""The corpus jobs from a command line: ``spark-submit`` this file, or ``python -m corpusloom.plans JOB ...``.

Every job reads local or shared paths, writes below --out and shows the counts that it returns.
Token counts need a public vocabulary: --ranks (a .tiktoken file) or --pieces (a SentencePiece model).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import language, tokens
from corpusloom.operators import catalog, decontam, filters, splits
from corpusloom.plans import jobs
from corpusloom.sources import readers


def _parser() -> argparse.ArgumentParser:
    # fixed values: the dates, seeds, limits and chunk size that are defaults below
    parser = argparse.ArgumentParser(prog="corpusloom.plans", description=__doc__)
    kinds = parser.add_subparsers(dest="job", required=True)

    def job(name: str, help: str, counts: bool) -> argparse.ArgumentParser:
        p = kinds.add_parser(name, help=help)
        p.add_argument("--out", required=True, help="folder to write to")
        if counts:
            which = p.add_mutually_exclusive_group(required=True)
            which.add_argument("--ranks", help="a .tiktoken file")
            which.add_argument("--pieces", help="a SentencePiece model")
        return p

    p = job("code", "filter code files by language", counts=True)
    p.add_argument("--root", required=True, help="folder with data/LANGUAGE in Parquet")
    p.add_argument("-l", "--langs", nargs="+", default=["all"], choices=["all", *filters.STACK_LANGUAGES])
    which = p.add_mutually_exclusive_group()
    which.add_argument("--english", help="SQL condition that holds for TeX files in English; tex needs it, or a model")
    which.add_argument("--language-model", help="Parquet table of trigram counts by language, as the job languages writes it")
    p.add_argument("--seed", type=int, default=74)

    p = job("repositories", "filter, decontaminate and split the files of repositories", counts=True)
    p.add_argument("--trees", required=True, help="folder with one checkout per directory")
    p.add_argument("--repositories", required=True, help="JSON lines of author, repo, lang, stars, created and save_path")
    p.add_argument("--commits", help="JSON lines of author, repo, sha, committed")
    p.add_argument("-l", "--langs", nargs="+", default=list(filters.GITHUB), choices=list(filters.GITHUB))
    p.add_argument("--limit", type=int, default=1000, help="repositories of a language")
    p.add_argument("--weekly", action="store_true", help="take repositories week by week, not by stars alone")
    p.add_argument("--init-date", default="2009-01-01")
    p.add_argument("--cutoff-date", default="2023-04-01")
    p.add_argument("--lean-held-out", nargs="*", default=[], help="JSON lists of held-out theorems, in order")
    p.add_argument("--isabelle-held-out", help="folder with JSON lists of held-out statements")
    p.add_argument("--dedup-chunk-size", type=int, default=2048)
    p.add_argument("--eval-ratio", type=float, default=splits.EVAL_RATIO)
    p.add_argument("--seed", type=int, default=72)

    p = job("proofs", "render proof traces", counts=False)
    p.add_argument("--traces", nargs="+", required=True, help="folders of traces")
    p.add_argument("--held-out", help="folder with JSON lists of held-out statements")

    p = job("steps", "split training text of modules", counts=True)
    which = p.add_mutually_exclusive_group(required=True)
    which.add_argument("--steps", help="JSON lines of module and text")
    which.add_argument("--modules", help="folder with Lean modules, for each of which --command is run")
    p.add_argument("--root", default="Mathlib", help="folder of modules in their names")
    p.add_argument("--command", nargs="+", default=["lake", "exe", "training_data", "{}", "--proofstep"], help="program and arguments; {} is the module")
    p.add_argument("--cwd", help="folder that the program runs in, on every executor")
    p.add_argument("--seed", type=int, default=7)

    p = job("languages", "train a model of languages", counts=False)
    p.add_argument("--labelled", required=True, help="JSON lines of text and lang")

    p = job("lines", "split files of lines by place", counts=False)
    p.add_argument("--path", required=True, help="folder of text files")
    return parser


def _repositories(spark: SparkSession, a: argparse.Namespace, lang: str) -> DataFrame:
    """The repositories of a language with the sha of their last commit up to the cutoff."""
    rows = readers.json_lines(spark, a.repositories, f"{readers.REPOSITORY}, save_path string")
    dated = rows.where(F.col("created").between(F.lit(a.init_date).cast("date"), F.lit(a.cutoff_date).cast("date")))
    if a.weekly:
        found = catalog.repos_by_week(rows, lang, a.init_date, a.cutoff_date, a.limit, distinct=True).drop("left", "right")
    else:
        found = catalog.top_repos(dated, lang, a.limit)
    commits = readers.json_lines(spark, a.commits, readers.COMMIT) if a.commits else spark.createDataFrame([], readers.COMMIT)
    return catalog.latest_as_of(found, commits, a.cutoff_date)


def _repository_job(spark: SparkSession, a: argparse.Namespace, counter) -> DataFrame:
    total = None
    for lang in a.langs:
        needles = names = None
        if lang == "lean" and a.lean_held_out:
            needles = decontam.theorem_needles(decontam.one_per_file(readers.held_out_names(spark, a.lean_held_out)))
        if lang == "isabelle" and a.isabelle_held_out:
            names = decontam.statement_names(readers.held_out_statements(spark, a.isabelle_held_out))
        rows = jobs.repository_corpus(spark, a.trees, _repositories(spark, a, lang), lang, a.out, counter, needles, names, a.dedup_chunk_size, a.eval_ratio, a.seed)
        total = rows if total is None else total.unionByName(rows)
    return total


def run(spark: SparkSession, argv: list[str] | None = None) -> DataFrame:
    """Run the job that the arguments name; returns its counts, or for proofs their number."""
    parser = _parser()
    a = parser.parse_args(argv)
    counter = None
    if getattr(a, "ranks", None):
        counter = tokens.ranks_counter(a.ranks)
    elif getattr(a, "pieces", None):
        counter = tokens.pieces_counter(a.pieces)
    if a.job == "code":
        langs = tuple(filters.STACK_LANGUAGES) if "all" in a.langs else tuple(a.langs)
        if "tex" in langs and a.english is None and a.language_model is None:
            parser.error("tex needs --english or --language-model")
        return jobs.code_corpus(spark, a.root, a.out, counter, langs, F.expr(a.english) if a.english else None, a.seed, a.language_model)
    if a.job == "languages":
        language.train(readers.json_lines(spark, a.labelled, "text string, lang string")).write.mode("overwrite").parquet(a.out)
        return spark.read.schema(language.MODEL).parquet(a.out).groupBy("lang").agg(F.sum("n").alias("trigrams"))
    if a.job == "repositories":
        return _repository_job(spark, a, counter)
    if a.job == "proofs":
        return jobs.proof_corpus(spark, a.traces, a.held_out, a.out).agg(F.count("*").alias("proofs"))
    if a.job == "steps":
        if a.steps:
            steps = readers.json_lines(spark, a.steps, "module string, text string")
        else:
            steps = jobs.extracted_steps(readers.module_names(spark, a.modules, a.root), f"{a.out}-failed", a.command, a.cwd)
        return jobs.step_corpus(spark, steps, counter, a.out, a.seed)
    return jobs.line_corpus(spark, a.path, a.out)


if __name__ == "__main__":
    session = SparkSession.builder.appName("corpusloom").getOrCreate()
    run(session).show(1000, truncate=False)
    session.stop()
