"""Train, validation and test splits that depend on keys alone, not on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.running import running_sum

EVAL_RATIO = 0.005


def eval_size(n: int, ratio: float = EVAL_RATIO) -> int:
    return max(int(ratio * n), 1)


def shuffled_by(key: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)


def hash_split(df: DataFrame, key: str, seed: int = 74, ratio: float = EVAL_RATIO) -> DataFrame:
    """df with split: of the order by hash, the last t rows are test, the t before validation.

    The row of rank 2t from the end gives the bound; it is found by range-wise counts of the
    hash's beginning, so no task sorts or holds more than one range of hashes.
    """
    hashed = df.select(F.col(key).alias("_k"), shuffled_by(key, seed).alias("_h"))
    n = hashed.count()
    t = eval_size(n, ratio)
    bounds = [_rank_from_end(hashed, m, n) for m in (t, 2 * t)]
    place = F.struct(shuffled_by(key, seed).alias("h"), F.col(key).cast("string").alias("k"))
    at_or_above = lambda b: F.lit(True) if b is None else place >= F.struct(F.lit(b[0]).alias("h"), F.lit(b[1]).alias("k"))
    if n == 0:
        return df.withColumn("split", F.lit("train"))
    return df.withColumn("split", F.when(at_or_above(bounds[0]), "test").when(at_or_above(bounds[1]), "validation").otherwise("train"))


def _rank_from_end(hashed: DataFrame, m: int, n: int) -> tuple[str, str] | None:
    """(hash, key) of the m-th row from the end; None if there are no more than m rows."""
    if m >= n:
        return None
    beginning, left = "", m
    while True:  # descend by four hex digits until the bucket is small
        width = len(beginning) + 4
        inside = hashed.where(F.startswith("_h", F.lit(beginning)))
        counts = inside.groupBy(F.substring("_h", 1, width).alias("b")).agg(F.count("*").alias("n")).orderBy(F.desc("b")).collect()  # 65536 at most
        for r in counts:
            if left <= r["n"]:
                beginning = r["b"]
                break
            left -= r["n"]
        if r["n"] <= 10_000 or width >= 64:
            rows = hashed.where(F.startswith("_h", F.lit(beginning))).select("_h", F.col("_k").cast("string").alias("k")).orderBy(F.desc("_h"), F.desc("k")).limit(left).collect()
            return rows[-1]["_h"], rows[-1]["k"]


def bernoulli_split(df: DataFrame, key: str, seed: int = 7, ratio: float = EVAL_RATIO) -> DataFrame:
    """df with split, each row by its own draw: below ratio validation, below twice that test."""
    draw = F.conv(F.substring(shuffled_by(key, seed), 1, 12), 16, 10).cast("bigint") / float(1 << 48)
    return df.withColumn("split", F.when(draw < ratio, "validation").when(draw < 2 * ratio, "test").otherwise("train"))


def positional_split(df: DataFrame, group: str, position: str) -> DataFrame:
    """df with split by place within its group: the first 99 % train, then validation, then test.

    position is a numeric total order within a group; places come from running counts, so no
    task sorts a whole group.
    """
    n = df.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_n"))
    joined = running_sum(df, group, position, F.lit(1), "_at").join(n, F.col(group).eqNullSafe(F.col("_g")))
    train = F.floor(F.col("_n") * 99 / 100)
    validation = F.floor((F.col("_n") - train) / 2)
    return joined.withColumn("split", F.when(F.col("_at") <= train, "train").when(F.col("_at") <= train + validation, "validation").otherwise("test")).drop("_g", "_n", "_at")
