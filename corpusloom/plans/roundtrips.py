"""Queries that write tables through the sinks and read them back through the readers, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import segments, stats
from corpusloom.plans.catalogue import query
from corpusloom.session import scratch_path, table
from corpusloom.sources import readers, sinks


@query("shard_sizes", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
s AS (SELECT lang, n, unnest(range((n + 99) // 100)) AS k FROM c)
SELECT 'split=' || lang || '/doc' || lpad(CAST(k AS VARCHAR), CAST(greatest(4, length(CAST(n // 100 + 1 AS VARCHAR))) AS INTEGER), '0') || '.jsonl' AS file, least(100, n - 100 * k) AS n FROM s""")
def shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in shards of a hundred for each language: the name and number of rows of every file."""
    path = scratch_path(spark, "shards")
    sinks.write_splits(table(spark, sf_dir, "documents").withColumn("split", F.col("lang")), path, 100, "doc")
    lines = spark.read.text(path).select(F.array_join(F.slice(F.split("_metadata.file_path", "/"), -2, 2), "/").alias("file"))
    return lines.groupBy("file").agg(F.count("*").alias("n"))


@query("shard_rows", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text and meta in JSON lines, read back with their schema."""
    path = scratch_path(spark, "shards")
    rows = sinks.as_documents(table(spark, sf_dir, "documents"), "text")
    sinks.write_shards(rows, path, 500)
    return readers.json_lines(spark, path, rows.schema.simpleString().removeprefix("struct<").removesuffix(">").replace("text:", "text ", 1).replace("meta:", "meta ", 1)).select("meta.doc_id", "text", "meta.lang", "meta.source", "meta.n_chars")


@query("lines_by_place", """
WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT source, count(*) AS lines, count(*) AS places, CAST(sum(length(line)) AS BIGINT) AS chars FROM l GROUP BY source""")
def lines_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as files of lines by source, read back with every line's number in its file; places counts distinct numbers of files."""
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text", "source").write.partitionBy("source").text(path)
    rows = readers.numbered_lines(spark, f"{path}/*/*.txt").withColumn("source", F.regexp_extract("file", "source=([^/]+)/", 1))
    files = rows.groupBy("source", "file").agg(F.count("*").alias("lines"), F.max("pos").alias("last"), F.sum(F.char_length("value")).alias("chars"))
    return files.groupBy("source").agg(F.sum("lines").alias("lines"), F.sum(F.col("last") + 1).alias("places"), F.sum("chars").alias("chars"))


@query("stats_upserted", """
SELECT lang, count(*) * CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS files, CAST(sum(n_chars) AS BIGINT) AS num_tokens FROM documents GROUP BY lang""")
def stats_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics written once for all languages, then again for one; the others stay."""
    path = scratch_path(spark, "stats")
    rows = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("files"), F.sum("n_chars").alias("num_tokens"))
    sinks.upsert_stats(rows, path)
    sinks.upsert_stats(rows.where("lang = 'en'").withColumn("files", F.col("files") * 2), path)
    return readers.json_lines(spark, path, "files bigint, num_tokens bigint, lang string").select("lang", "files", "num_tokens")


@query("index_lines", "SELECT DISTINCT source AS value FROM documents WHERE source IS NOT NULL")
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of sources, written and read back."""
    path = scratch_path(spark, "index")
    sinks.write_index(table(spark, sf_dir, "documents"), "source", path)
    return spark.read.text(path)


@query("code_files_read", "SELECT CAST(doc_id AS VARCHAR) AS hexsha, n_chars AS size, text AS content FROM documents WHERE lang = 'en'")
def code_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stored as code files by language, and one language read by the code reader."""
    path = scratch_path(spark, "code")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("hexsha"), F.col("n_chars").alias("size"), F.col("text").alias("content"), "lang")
    rows.write.partitionBy("lang").parquet(f"{path}/data")
    files = readers.code_files(spark, path, "lang=en")
    return files.select("hexsha", "size", "content")


@query("tree_files_read", "SELECT text || chr(10) AS text FROM benchmark")
def tree_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as a file each, and the tree of them read."""
    path = scratch_path(spark, "tree")
    table(spark, sf_dir, "benchmark").select("text").write.option("maxRecordsPerFile", 1).text(path)
    return readers.source_tree(spark, path, ".txt").select("text")


def named_files(df: DataFrame, path: str) -> None:
    """Write (name, value) as one text file each."""
    sinks.write_named(df.repartition("name").sortWithinPartitions("name"), path)


@query("trace_files_read", """
WITH n AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS segment FROM conversations)
SELECT conv_id || '_' || segment AS theory, count(*) AS steps, md5(string_agg(role || ' ' || text, '|' ORDER BY turn)) AS digest FROM n GROUP BY conv_id, segment""")
def trace_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of conversations as files of proof traces, and the traces read from the folder."""
    path = scratch_path(spark, "traces")
    rows = segments.numbered_segments(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user")
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.array(x["role"], x["text"]))
    traces = rows.groupBy("conv_id", "segment").agg(F.to_json(F.struct(pairs.alias("translations"))).alias("value"))
    name = F.concat(F.lit("2022-12-06_thys_"), F.concat_ws("_", F.col("conv_id").cast("string"), F.col("segment").cast("string")), F.lit(".thy_output.json"))
    named_files(traces.select(name.alias("name"), "value"), path)
    steps = F.transform("translations", lambda x: F.concat_ws(" ", x))
    return readers.proof_traces(spark, path).select("theory", F.size("translations").cast("bigint").alias("steps"), F.md5(F.array_join(steps, "|")).alias("digest"))


@query("module_files_read", "SELECT 'Mathlib.Item' || item_id AS module FROM benchmark")
def module_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as files of modules, and the modules' names found in the tree."""
    path = scratch_path(spark, "modules")
    items = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("Item"), "item_id", F.lit(".lean")).alias("name"), F.col("text").alias("value"))
    named_files(items, f"{path}/Mathlib")
    return readers.module_names(spark, path, "Mathlib")


@query("pages_by_number", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 250")
def pages_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five pages of fifty documents, each read from the key of the one before."""
    pager = stats.Pager(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return spark.createDataFrame([(r["doc_id"],) for _ in range(5) for r in pager.head(50)], "doc_id long")
