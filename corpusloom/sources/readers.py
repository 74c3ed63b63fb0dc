"""Readers with declared schemas. Nothing is inferred and nothing is fetched from a network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import theory_of
from corpusloom.sources.archives import members


# The columns of a code file.
CODE_FILE = """
    hexsha string, size bigint, ext string, lang string,
    max_stars_repo_path string, max_stars_repo_name string, max_stars_repo_head_hexsha string, max_stars_repo_licenses array<string>,
    max_stars_count bigint, max_stars_repo_stars_event_min_datetime string, max_stars_repo_stars_event_max_datetime string,
    max_issues_repo_path string, max_issues_repo_name string, max_issues_repo_head_hexsha string, max_issues_repo_licenses array<string>,
    max_issues_count bigint, max_issues_repo_issues_event_min_datetime string, max_issues_repo_issues_event_max_datetime string,
    max_forks_repo_path string, max_forks_repo_name string, max_forks_repo_head_hexsha string, max_forks_repo_licenses array<string>,
    max_forks_count bigint, max_forks_repo_forks_event_min_datetime string, max_forks_repo_forks_event_max_datetime string,
    content string, avg_line_length double, max_line_length bigint, alphanum_fraction double
"""
REPOSITORY = "author string, repo string, lang string, stars bigint, created date"
COMMIT = "author string, repo string, sha string, committed timestamp"
TRACE = "translations array<array<string>>"
HELD_OUT_STATEMENTS = "array<array<string>>"
HELD_OUT_NAMES = "array<struct<file_path:string,full_name:string>>"
#: Rows of repositories that are broadcast (about 300 bytes each).
REPOSITORIES_AT_ONCE = 100_000
#: What the command line skips unless told otherwise.
MAX_ARCHIVE_BYTES = 1_000_000_000


def code_files(spark: SparkSession, root: str, language: str) -> DataFrame:
    """Code files of a language: Parquet under root/data/language."""
    return spark.read.schema(CODE_FILE).parquet(f"{root}/data/{language}")


def _decoded(binary: str) -> F.Column:
    """Strict UTF-8 with one kind of line end; null if it isn't UTF-8."""
    text = F.when(F.is_valid_utf8(F.col(binary).cast("string")), F.col(binary).cast("string"))
    return F.regexp_replace(text, "\r\n?", "\n")


def source_tree(spark: SparkSession, path: str, extension: str, repos: DataFrame | None = None) -> DataFrame:
    """(text, path) of the files with the extension, at any depth; files that aren't UTF-8 are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").option("recursiveFileLookup", "true").load(path)
    return files.select(_decoded("content").alias("text"), F.col("path")).where("text IS NOT NULL")


def extracted(spark: SparkSession, path: str, extension: str, repos: DataFrame) -> DataFrame:
    """(text, meta): files of local checkouts, with the repository whose save_path holds each.

    A file belongs to the repository named by the directory right below path, so the join is on
    an equal key. Repositories are broadcast up to REPOSITORIES_AT_ONCE of them, and else meet the files' paths first, which are
    short; texts then join by their path, so a large repository is no single task.
    """
    tree = source_tree(spark, path, extension)
    top = F.regexp_extract("path", r"(?:^|/)" + _quoted(path.rstrip("/").rsplit("/", 1)[-1]) + r"/([^/]+)/", 1)
    held = repos.withColumn("_top", F.element_at(F.split("save_path", "/"), -1))
    if held.count() <= REPOSITORIES_AT_ONCE:
        joined = tree.withColumn("_top", top).join(F.broadcast(held), "_top")
    else:
        joined = tree.join(tree.select("path", top.alias("_top")).join(held, "_top"), "path")
    return joined.select("text", F.struct("author", "repo", "sha", "save_path", "path").alias("meta"))


def _quoted(s: str) -> str:
    return r"\Q" + s + r"\E"


def archives(spark: SparkSession, path: str, extension: str, max_bytes: int | None = None) -> DataFrame:
    """(archive, path, text) of the files in tar archives of any size (see sources/archives.py); those beyond max_bytes, if given, are skipped whole."""
    found = members(spark, path, extension, max_bytes).where("path IS NOT NULL")
    return found.select("archive", "path", F.regexp_replace("text", "\r\n?", "\n").alias("text"))


def _json_files(spark: SparkSession, path: str, schema: str, pattern: str) -> DataFrame:
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return raw.select(F.substring_index("path", "/", -1).alias("file"), F.from_json(F.col("content").cast("string"), schema).alias("json"))


def proof_traces(spark: SparkSession, path: str) -> DataFrame:
    """(file, theory, translations) of proof traces; files without translations are left out."""
    rows = _json_files(spark, path, TRACE, "*thy_output.json").select("file", theory_of(F.col("file")).alias("theory"), F.col("json.translations").alias("translations"))
    return rows.where("translations IS NOT NULL")


def held_out_statements(spark: SparkSession, path: str) -> DataFrame:
    """(file, statement) of every entry with a second element; empty ones are refused."""
    rows = _json_files(spark, path, HELD_OUT_STATEMENTS, "*.json").select("file", F.explode("json").alias("x")).where(F.size("x") > 1)
    return rows.select("file", F.get("x", F.lit(1)).alias("statement")).where("statement <> ''")


def held_out_names(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, name, rank) of held-out theorems, ranked by list and place in it."""
    parts = []
    for k, p in enumerate(paths):
        raw = spark.read.option("wholetext", True).text(p).select(F.posexplode(F.from_json("value", HELD_OUT_NAMES)).alias("place", "x"))
        parts.append(raw.select(F.col("x.file_path").alias("file"), F.col("x.full_name").alias("name"), (F.lit(k).cast("bigint") * (1 << 32) + F.col("place")).alias("rank")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, value) of text files, pos being the line's number in its file.

    Lines keep their order within a split of a file; splits are ordered by their offset, so a
    count per split gives every line's number without a sort of the text.
    """
    from pyspark.sql import Window

    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"), "value")
    blocks = raw.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("_id").alias("first"))
    before = blocks.select("file", "block", "first", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))
    return raw.join(before, ["file", "block"]).select("file", (F.col("before") + F.col("_id") - F.col("first")).alias("pos"), "value")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def module_names(spark: SparkSession, path: str, root: str, limit: int | None = None) -> DataFrame:
    """Dotted names of the Lean modules below root, in order."""
    from corpusloom.functions.text import module_name

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.lean").option("recursiveFileLookup", "true").load(path).select("path")
    names = files.select(module_name(F.regexp_extract("path", r"(?:^|/)(" + _quoted(root) + r"/.*)$", 1)).alias("module")).where("module <> ''").orderBy("module")
    return names.limit(limit) if limit is not None else names
