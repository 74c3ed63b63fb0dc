"""Repository catalogues: weekly intervals, repositories by week or by stars, commits as of a date."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def week_intervals(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(left, right), seven days apart, right no later than end; the last may be a single day."""
    if datetime.date.fromisoformat(start) > datetime.date.fromisoformat(end):
        raise ValueError("start is after end")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 7 days"))).alias("left"))
    return days.select("left", F.least(F.date_add("left", 7), F.lit(end).cast("date")).alias("right"))


def in_weeks(df: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """df with left and right of each interval that holds its day; a day on an edge is in two.

    Intervals follow from the day, so there is no join: the row's own week, and the one that ends on it.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    d = F.col(day).cast("date")
    k = F.floor(F.datediff(d, first) / 7).cast("int")
    on_edge = (F.datediff(d, first) % 7 == 0) & (k > 0)
    weeks = F.when(on_edge, F.array(k - 1, k)).otherwise(F.array(k))
    rows = df.where((d >= first) & (d <= last)).withColumn("_k", F.explode(weeks))
    left = F.date_add(first, F.col("_k") * 7)
    return rows.withColumn("left", left).withColumn("right", F.least(F.date_add(F.col("left"), 7), last)).drop("_k")


def top_repos(catalog: DataFrame, lang: str, limit: int) -> DataFrame:
    """The repositories of a language with the most stars; ties by author and name."""
    return catalog.where(F.col("lang") == lang).orderBy(F.desc("stars"), "author", "repo").limit(limit)


def repos_by_week(catalog: DataFrame, lang: str, start: str, end: str, limit: int, distinct: bool = False) -> DataFrame:
    """Week by week, most stars first, up to the limit; distinct drops what an edge repeats."""
    rows = in_weeks(catalog.where(F.col("lang") == lang), "created", start, end)
    if distinct:
        rows = rows.groupBy([c for c in rows.columns if c not in ("left", "right")]).agg(F.min("left").alias("left"), F.min("right").alias("right"))
    return rows.orderBy("left", F.desc("stars"), "author", "repo").limit(limit)


def latest_as_of(repos: DataFrame, commits: DataFrame, cutoff: str | None, default: str = "master") -> DataFrame:
    """repos with sha of the latest commit up to the cutoff, or the default."""
    before = commits.where(F.col("committed") <= F.lit(cutoff).cast("timestamp")) if cutoff else commits
    latest = before.groupBy("author", "repo").agg(F.max_by("sha", F.struct("committed", "sha")).alias("sha"))
    return repos.join(latest, ["author", "repo"], "left").withColumn("sha", F.coalesce("sha", F.lit(default)))


def latest_by(df: DataFrame, key: str, at: str, tie: str, cutoff: str) -> DataFrame:
    """For each key, the row's tie column of the latest row up to the cutoff."""
    return df.where(F.col(at) <= F.lit(cutoff).cast("timestamp")).groupBy(key).agg(F.max_by(tie, F.struct(at, tie)).alias(tie), F.max(at).alias(at))
