"""Corpus statistics, repository indexes, and views for inspection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusloom.functions.text import numerical_density


def corpus_stats(df: DataFrame, *by: str, size: Column, tokens: Column) -> DataFrame:
    """files, size and num_tokens of each group."""
    return df.groupBy(*by).agg(F.count("*").alias("files"), F.sum(size).alias("size"), F.sum(tokens).alias("num_tokens"))


def with_cumulative(df: DataFrame, by: str, size: Column, tokens: Column) -> DataFrame:
    """corpus_stats() of each group and, as CUMULATIVE, of all."""
    rows = df.rollup(by).agg(F.grouping(by).alias("_all"), F.count("*").alias("files"), F.sum(size).alias("size"), F.sum(tokens).alias("num_tokens"))
    return rows.withColumn(by, F.when(F.col("_all") == 1, "CUMULATIVE").otherwise(F.col(by))).drop("_all")


def index_of(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def transformed_count(df: DataFrame, flag: str = "was_transformed") -> DataFrame:
    return df.agg(F.sum(F.col(flag).cast("bigint")).alias("transformed"))


def extremes(df: DataFrame, by: Column, key: str, n: int, largest: bool) -> DataFrame:
    """The n rows at one end of an order, ties by key: a report, hence the limit."""
    return df.withColumn("measure", by).orderBy(F.desc("measure") if largest else F.asc("measure"), key).limit(n)


def longest(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    return extremes(df, F.char_length(text), key, n, True)


def densest(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    return extremes(df, numerical_density(F.col(text)), key, n, True)


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """A repeatable random order for looking at samples."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key)


class Pager:
    """Looks at a DataFrame's rows n at a time from either end of the order of some columns, nulls being the least.

    A page begins after the last key seen, which is a predicate on the columns, so pages before it are not sorted again
    and rows that are added before it meanwhile shift nothing. Rows of one key are in order of a hash of the whole row;
    only rows that repeat are skipped by number.
    """

    def __init__(self, df: DataFrame, *order: str):
        self.df, self.order, self.seen = df, [*order, "_tie"], {"head": (None, 0), "tail": (None, 0)}

    def head(self, n: int = 1) -> list:
        return self._next("head", n)

    def tail(self, n: int = 1) -> list:
        return self._next("tail", n)

    def _from(self, key: tuple, up: bool) -> Column:
        """Rows of this key, and those after it."""
        after, same = F.lit(False), F.lit(True)
        for name, value in zip(self.order, key):
            c = F.col(name)
            if value is None:
                beyond = c.isNotNull() if up else F.lit(False)
            else:
                beyond = c > F.lit(value) if up else (c < F.lit(value)) | c.isNull()
            after = after | (same & beyond)
            same = same & c.eqNullSafe(F.lit(value))
        return after | same

    def _next(self, end: str, n: int) -> list:
        key, times = self.seen[end]
        up = end == "head"
        hashed = self.df.withColumn("_tie", F.xxhash64(*self.df.columns))
        rows = hashed if key is None else hashed.where(self._from(key, up))
        keys = F.struct(*self.order).alias("_key")
        by = [F.asc_nulls_first(c) if up else F.desc_nulls_last(c) for c in self.order]
        page = rows.orderBy(*by).offset(times).limit(n).select("*", keys).collect()
        if page:
            last = tuple(page[-1]["_key"])
            repeats = sum(tuple(r["_key"]) == last for r in page)
            self.seen[end] = last, repeats + (times if last == key else 0)
        return [Row(**{c: r[c] for c in self.df.columns}) for r in page]
