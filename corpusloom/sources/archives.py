"""A data source of the files in gzipped tar archives, read member by member.

Each archive is a partition. Its bytes are decompressed as a stream, so a task holds one batch of members
(BATCH_BYTES, or one member) whatever the archive's size. A member that isn't UTF-8 is left out. An archive that is cut or broken gives the
members before the fault, and then a row with the error and no member.

    spark.dataSource.register(ArchiveSource)
    spark.read.format("tar_members").option("extension", ".lean").load("/folder/of/archives")

Paths may have any scheme that pyarrow's file systems know; without one, they are local or shared paths.
"""

from __future__ import annotations

import gzip
import json
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Text of a batch of members.
BATCH_BYTES = 4 << 20
SCHEMA = "archive string, path string, text string, error string"
_BROKEN = (tarfile.TarError, EOFError, OSError, zlib.error)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system of path, and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


class ArchivePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str], extension: str, batch_bytes: int = BATCH_BYTES):
        self.paths, self.extension, self.batch_bytes = paths, extension, batch_bytes

    def partitions(self) -> list[ArchivePartition]:
        return [ArchivePartition(p) for p in self.paths]

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        def batch(error: str | None = None) -> pa.RecordBatch:
            n = len(rows) + (error is not None)
            names, texts = ([r[k] for r in rows] + [None] * (error is not None) for k in (0, 1))
            columns = [[partition.path] * n, names, texts, [None] * len(rows) + [error] * (error is not None)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["archive", "path", "text", "error"])

        rows: list[tuple[str, str]] = []
        held, error = 0, None
        try:
            fs, path = file_system(partition.path)
            with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain, tarfile.open(fileobj=plain, mode="r|") as tar:
                for member in tar:
                    if member.isfile() and member.name.endswith(self.extension):
                        try:
                            text = tar.extractfile(member).read().decode("utf-8")
                        except UnicodeDecodeError:
                            continue
                        rows.append((member.name, text))
                        held += member.size
                        if held >= self.batch_bytes:
                            yield batch()
                            rows, held = [], 0
                    tar.members = []  # a stream needs no list of what has been read
                while plain.read(1 << 20):  # tarfile takes a cut between members for the end, gzip does not
                    pass
        except _BROKEN as e:
            error = f"{type(e).__name__}: {e}"
        yield batch(error)


class ArchiveSource(DataSource):
    """Options: path (or paths, a JSON list of archives) and extension."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(json.loads(self.options["paths"]), self.options.get("extension", ""))


def members(spark: SparkSession, path: str, extension: str, max_bytes: int | None = None) -> DataFrame:
    """(archive, path, text, error) of all *.tar.gz below path, listed by Spark; archives beyond max_bytes, if given, are left out."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar.gz").load(path).select("path", "length")
    some = listed if max_bytes is None else listed.where(F.col("length") <= max_bytes)
    paths = sorted(r["path"] for r in some.select("path").collect())  # names only
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("tar_members").option("paths", json.dumps(paths)).option("extension", extension).load()
