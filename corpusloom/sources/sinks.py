"""Writers: sharded JSON lines, indexes and statistics."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.running import row_numbers
from corpusloom.sources.archives import file_system

SHARD_ROWS = 50_000
#: Rows that a task writes if shards are smaller.
TASK_ROWS = 10_000


def as_documents(df: DataFrame, content: str = "content") -> DataFrame:
    """(text, meta), meta being all other columns."""
    rest = [c for c in df.columns if c != content]
    return df.select(F.col(content).alias("text"), F.struct(*rest).alias("meta"))


def _files(spark: SparkSession, path: str):
    """The file system of path, and a function that makes paths below it."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda name: jvm.org.apache.hadoop.fs.Path(folder, name) if name else folder


def _names(fs, folder) -> list[str]:
    return sorted(f.getPath().getName() for f in fs.listStatus(folder))


def _digits(n: int, rows: int) -> int:
    return max(4, len(str(n // rows + 1)))


def shard_name(stem: str, shard: int, n: int, rows: int) -> str:
    """Name of a shard of n documents, rows in each: four digits, or as many as the number of shards has."""
    return f"{stem}{shard:0{_digits(n, rows)}}.jsonl"


def _folder_name(split: str | None) -> str:
    """split=NAME as Spark names the folder of a partition; null and empty names are one."""
    escaped = re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", split or "__HIVE_DEFAULT_PARTITION__")
    return f"split={escaped}/"


def _known(path: str) -> bool:
    """Whether pyarrow's file systems know the scheme of path."""
    try:
        return file_system(path) is not None
    except (pa.ArrowException, OSError):
        return False


def write_named(df: DataFrame, path: str) -> None:
    """Write (name, value) as one text file a name, below path, a row a line; a name may have folders.

    Rows of a name must be next to each other in one partition. Tasks write the files themselves, each under a hidden name
    until it is whole, so nothing passes the driver. Only in a store that pyarrow's file systems don't know, Spark's
    writer makes a folder of every name and the driver moves its file.
    """
    rows = df.select(F.coalesce("name", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("name"), F.col("value").cast("string").cast("binary").alias("value"))
    fs, at = _files(df.sparkSession, path)
    fs.mkdirs(at(""))
    if not _known(path):
        _moved_by_driver(rows, path)
        return

    def write(batches):
        store, root = file_system(path)
        root, made, name, out, hidden = root.rstrip("/"), set(), None, None, None

        def end():
            out.close()
            store.move(hidden, f"{root}/{name}")

        try:
            for batch in batches:
                for its, value in zip(batch.column("name").to_pylist(), batch.column("value")):
                    if its != name:
                        if out:
                            end()
                            out = None
                        folder, _, last = f"{root}/{its}".rpartition("/")
                        if folder not in made:
                            store.create_dir(folder, recursive=True)
                            made.add(folder)
                        name, hidden = its, f"{folder}/_{uuid.uuid4().hex}"
                        out = store.open_output_stream(hidden, compression=None, buffer_size=1 << 16)
                    out.write((value.as_py() or b"") + b"\n")
            if out:
                end()
                out = None
        finally:
            if out:
                out.close()
                store.delete_file(hidden)
        yield from ()

    rows.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


def _moved_by_driver(rows: DataFrame, path: str) -> None:
    """The files of write_named() by Spark's writer and the driver, one after the other; only names pass the driver."""
    rows.select("name", F.col("value").cast("string").alias("value")).write.partitionBy("name").text(f"{path}-parts")
    fs, at = _files(rows.sparkSession, f"{path}-parts")
    _, to = _files(rows.sparkSession, path)
    for folder in _names(fs, at("")):
        if folder.startswith("name="):
            (part,) = (x for x in _names(fs, at(folder)) if x.startswith("part-"))
            target = to(unquote(folder.removeprefix("name=")))
            fs.mkdirs(target.getParent())
            if not fs.rename(at(f"{folder}/{part}"), target):
                raise OSError(f"can't rename {folder}/{part} in {path}-parts")
    fs.delete(at(""), True)


def write_splits(df: DataFrame, path: str, rows: int = SHARD_ROWS, stem: str = "part-") -> None:
    """JSON lines in a folder split=NAME for each split; every shard but a split's last has exactly rows documents.

    Rows are numbered within their split in two passes, and dealt to tasks by number div rows, so a shard is
    one file of one task; small shards share a task. Shards are named after stem and a running number, of four digits or as many as the split's shards need.
    """
    _write_shards(df, path, rows, stem, _folder_name)


def write_shards(df: DataFrame, path: str, rows: int = SHARD_ROWS, stem: str = "part-") -> None:
    """JSON lines of exactly rows documents a file, but the last; every row is written."""
    _write_shards(df.withColumn("split", F.lit("all")), path, rows, stem, lambda split: "")


def _write_shards(df: DataFrame, path: str, rows: int, stem: str, folder: Callable[[str | None], str]) -> None:
    spark, split = df.sparkSession, F.col("split").cast("string")
    numbered = row_numbers(df.withColumn("split", F.when(split != "", split)), "split", "_number")
    sizes = [(r["split"], r["n"]) for r in numbered.groupBy("split").agg(F.count("*").alias("n")).collect()]
    shards, total = sum(-(-n // rows) for _, n in sizes), sum(n for _, n in sizes)
    begins = spark.createDataFrame([(k, folder(k) + stem, _digits(n, rows)) for k, n in sizes], "_split string, _begin string, _digits int")
    named = numbered.join(F.broadcast(begins), F.col("split").eqNullSafe(F.col("_split")))
    shard = F.floor(F.col("_number") / rows).cast("string")
    name = F.concat("_begin", F.lpad(shard, F.greatest("_digits", F.length(shard)), F.lit("0")), F.lit(".jsonl"))
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns if c != "split")), {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"})
    tasks = max(1, min(shards, max(spark.sparkContext.defaultParallelism, -(-total // TASK_ROWS))))
    dealt = named.select(name.alias("name"), line.alias("value"), "_number").repartition(tasks, "name").sortWithinPartitions("name", "_number")
    fs, at = _files(spark, path)
    fs.delete(at(""), True)
    write_named(dealt, path)
    fs.create(at("_SUCCESS")).close()



def write_index(df: DataFrame, column: str, path: str) -> None:
    """Distinct values, sorted, a line each, range-partitioned over files."""
    df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct().orderBy("value").write.mode("overwrite").text(path)


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(column, "split").write.mode("overwrite").partitionBy("split").text(path)


def upsert_stats(stats: DataFrame, path: str, by: str = "lang") -> None:
    """Replace the rows of the languages in stats, one directory each, and keep the others."""
    stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(path)
