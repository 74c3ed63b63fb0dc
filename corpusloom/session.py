"""Tables, and scratch space that every executor can reach."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df, dealt anew over all cores if it comes of fewer files than there are cores; for work that costs far more than its rows' way.

    A file of one row group is one task, however long its rows take. Large tables have more files than a
    cluster has cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master, whose driver and executors are one process, may go without the
    setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{tempfile.gettempdir()}/corpusloom-scratch"
    return f"{root.rstrip('/')}/corpusloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in scratch space."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to scratch space and read it back.

    It cuts the lineage, so a lost executor costs no more than the reading task, and later
    readers get column pruning, which a checkpoint lacks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _calls()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


#: What a task sends to a Python worker at once, within small_batches().
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
_batches = threading.Lock()
_before: list[dict[str, str]] = []


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored meanwhile send Python workers BATCH_CONF at once, as an executor holds a batch several times over.

    The session's own settings are back when the last of the calls that are under way ends.
    """
    with _batches:
        _before.append(_before[-1] if _before else {k: spark.conf.get(k) for k in BATCH_CONF})
        for k, v in BATCH_CONF.items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _batches:
            before = _before.pop()
            for k, v in before.items() if not _before else ():
                spark.conf.set(k, v)


_thread = threading.local()


def _calls() -> list[list[str]]:
    """What stored() has written in this thread, by the calls of settled() that are under way; the last list is that of the innermost."""
    if not hasattr(_thread, "calls"):
        _thread.calls = [[]]
    return _thread.calls


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The result of make(), stored; all that make() itself has stored is deleted, as the result needs nothing of it.

    When the outermost call ends, the JVM is asked to collect its garbage, so that Spark drops shuffle files that no plan needs.
    """
    calls = _calls()
    calls.append([])
    try:
        result = stored(make(), name)
    finally:
        inner = calls.pop()
    *gone, kept = inner
    jvm = spark.sparkContext._jvm
    for path in gone:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    calls[-1].append(kept)
    if len(calls) == 1:
        gc.collect()
        jvm.java.lang.System.gc()
    return result


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that stored() has written in this application; its results must be read by then."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    del _calls()[0][:]
