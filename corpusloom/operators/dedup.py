"""Exact de-duplication by fixed-size chunks.

A document goes if one of its chunks is not the first of its kind, by document order and then
by place; so one that repeats a chunk within itself goes too, and what dropped documents have
counts as seen. Only whole chunks count, and whole short documents. Empty documents stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_hashes(df: DataFrame, key: Column, text: Column, size: int) -> DataFrame:
    """(key, place, hash) of each chunk that counts; texts go no further."""
    n = F.char_length(text)
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(n / size).cast("int") - 1)))
    return df.select(key.alias("key"), text.alias("text"), F.explode(places).alias("place")).select("key", "place", F.sha2(F.substring(F.col("text"), F.col("place") * size + 1, F.lit(size)), 256).alias("hash"))


def chunk_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2048, within: bool = True) -> DataFrame:
    """Rows without a chunk that came before; key gives the order and is unique.

    within=False ignores repeats within one document. Hashes are reduced to their first
    occurrence by aggregation, so a very frequent chunk costs a row per task.
    """
    chunks = chunk_hashes(df, F.col(key), F.col(text), size)
    if not within:
        chunks = chunks.groupBy("key", "hash").agg(F.min("place").alias("place"))
    first = chunks.groupBy("hash").agg(F.min(F.struct("key", "place")).alias("first")).select(F.col("first.key").alias("key"))
    had = chunks.groupBy("key").agg(F.count("*").alias("had"))
    won = first.groupBy("key").agg(F.count("*").alias("won"))
    late = had.join(won, "key", "left").where(F.col("had") > F.coalesce("won", F.lit(0))).select(F.col("key").alias(key))
    return df.join(late, key, "left_anti")
