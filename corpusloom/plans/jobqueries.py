"""Queries that run whole jobs, streams and external programs over the given tables, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.external import through_program
from corpusloom.plans import jobs
from corpusloom.plans.catalogue import query, standard_sql
from corpusloom.plans.roundtrips import named_files
from corpusloom.session import scratch_path, stored, table
from corpusloom.sources import readers
from corpusloom.streaming import feeds

#: Text of a file that a stream reads, however many files that makes.
STREAM_FILE_BYTES = 16 << 20


def _words(text: Column) -> Column:
    return F.size(F.split(text, " ")).cast("bigint")


@query("code_job", f"""
SELECT CASE WHEN doc_id % 2 = 0 THEN 'gap' ELSE 'idris' END AS lang, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS size, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS num_tokens
FROM documents WHERE {standard_sql("text")} GROUP BY ALL""")
def code_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of the code job over documents as files of two languages, counted in words."""
    path = scratch_path(spark, "code-job")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("hexsha"), F.col("n_chars").alias("size"), F.col("text").alias("content"))
    for lang, rest in (("gap", 0), ("idris", 1)):
        rows.where(F.col("hexsha").cast("bigint") % 2 == rest).write.parquet(f"{path}/in/data/{lang}")
    return jobs.code_corpus(spark, f"{path}/in", f"{path}/out", _words, ("gap", "idris")).select("lang", "files", "size", "num_tokens")


@query("step_job", """
WITH d AS (SELECT len(string_split(text, ' ')) AS words, CAST(('0x' || substr(sha256('7:' || CAST(doc_id AS VARCHAR)), 1, 12)) AS BIGINT) / 281474976710656.0 AS u FROM documents)
SELECT CASE WHEN u < 0.005 THEN 'validation' WHEN u < 0.01 THEN 'test' ELSE 'train' END AS split, count(*) AS rows, CAST(sum(words) AS BIGINT) AS tokens FROM d GROUP BY ALL""")
def step_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split sizes of the step job over documents as modules, counted in words."""
    steps = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("module"), "text")
    return jobs.step_corpus(spark, steps, _words, scratch_path(spark, "step-job"))


@query("held_out_files_read", "SELECT CAST(item_id AS VARCHAR) || '.json' AS file, text AS statement FROM benchmark WHERE text <> ''")
def held_out_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as held-out lists, a file each, read by the reader of statements."""
    path = scratch_path(spark, "held-out")
    entry = F.to_json(F.array(F.array(F.lit("id"), F.col("text")), F.array(F.lit("alone"))))
    named_files(table(spark, sf_dir, "benchmark").select(F.concat(F.col("item_id"), F.lit(".json")).alias("name"), entry.alias("value")), path)
    return readers.held_out_statements(spark, path)


@query("program_output", "SELECT DISTINCT source, 'source ' || source AS text, 0 AS code FROM documents WHERE source IS NOT NULL")
def program_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an external program prints for each source."""
    sources = table(spark, sf_dir, "documents").select("source").where("source IS NOT NULL").distinct()
    return through_program(sources, "source", ["printf", "source %s", "{}"]).where("error IS NULL").select("source", "text", "code")


@query("stream_kept", f"SELECT doc_id FROM documents WHERE {standard_sql('text')}")
def stream_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of files through the rule of a language, in batches of two files, or of a file for each core."""
    path = scratch_path(spark, "stream")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    size = docs.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    files = max(5, -(-size // STREAM_FILE_BYTES))
    docs.repartition(files, "doc_id").write.parquet(f"{path}/in")
    at_once = 2 if files == 5 else max(2, spark.sparkContext.defaultParallelism)
    kept = feeds.kept_stream(feeds.document_stream(spark, f"{path}/in", "doc_id bigint, content string", at_once), "gap")
    feeds.write_stream(kept.select("doc_id"), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema("doc_id bigint").parquet(f"{path}/out")


@query("stream_weeks", """
WITH w AS (SELECT CAST(floor(epoch(ts) / 604800) AS BIGINT) AS week, event_type, count(*) AS n FROM events GROUP BY ALL),
late AS (SELECT floor((epoch(max(ts)) - 86400) / 604800) AS week FROM events)
SELECT CAST(DATE '1970-01-01' + CAST(w.week * 7 AS INTEGER) AS VARCHAR) AS week, event_type, n FROM w, late WHERE w.week < late.week""")
def stream_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream, counted by week and type; weeks that the watermark has not passed are not final and not written."""
    path = scratch_path(spark, "stream")
    events = stored(table(spark, sf_dir, "events").select("ts", "event_type", "value"), "events")
    events.write.parquet(f"{path}/in")
    weeks = feeds.weekly_counts(feeds.document_stream(spark, f"{path}/in", "ts timestamp, event_type string, value double"))
    feeds.write_stream(weeks, f"{path}/out", f"{path}/state").awaitTermination()
    rows = spark.read.schema(weeks.schema).parquet(f"{path}/out")
    return rows.select(F.to_date("week.start").cast("string").alias("week"), "event_type", "n")
