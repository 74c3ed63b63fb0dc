"""Streams: the row filters hold for them as they are; events fall into weekly windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators import filters


def document_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def kept_stream(docs: DataFrame, language: str, specs=filters.STACK) -> DataFrame:
    """Stateless, so any output mode and restart will do."""
    return filters.keep_language(docs, language, specs)


def weekly_counts(events: DataFrame, at: str = "ts", late: str = "1 day") -> DataFrame:
    """Events per week and type; a week is final once the watermark has passed it."""
    return events.withWatermark(at, late).groupBy(F.window(at, "7 days").alias("week"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, exactly once, until what is there has been read."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
