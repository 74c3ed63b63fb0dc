"""Running sums and row numbers over tables and groups of any size, in two levels: within ranges of rows, and over the ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stored

#: Rows of a range, which one task sorts.
RANGE_ROWS = 1 << 20


def in_ranges(df: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """df with _range: ranges of the order, of about RANGE_ROWS rows each, so their number follows the table's.

    Spark samples the edges and finds each row's by binary search. The rows are stored, as another sample might cut them elsewhere.
    """
    n = ranges or -(-df.count() // RANGE_ROWS) or 1
    return stored(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def running_sum(df: DataFrame, group: str, order: str, value: Column, name: str, ranges: int | None = None) -> DataFrame:
    """df with name: the sum of value over the rows of the group up to and including this one.

    order is total within a group. Ranges cut the order of group and position; sums per group and range are
    added up first, so a task sorts a range of a group at a time and not a whole group, however large it is.
    """
    dealt = in_ranges(df.withColumn("_value", value), [group, order], ranges)
    sums = dealt.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_r")).agg(F.sum("_value").alias("_sum"))
    before = sums.select("_group", "_r", (F.sum("_sum").over(Window.partitionBy("_group").orderBy("_r")) - F.col("_sum")).alias("_before"))
    local = F.sum("_value").over(Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    joined = dealt.withColumn("_local", local).join(before, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn(name, F.col("_local") + F.col("_before")).drop("_range", "_value", "_group", "_r", "_before", "_local")


def row_numbers(df: DataFrame, group: str, name: str) -> DataFrame:
    """df with name: 0, 1, 2, ... within the group, gapless, in the order that the table has (task by task, row by row).

    The rows are stored with their task and place, rows of a group are counted by task, and counts of earlier tasks added.
    """
    placed = stored(df.withColumn("_place", F.monotonically_increasing_id()), "rows")
    task = F.shiftright("_place", 33)
    placed = placed.withColumn("_task", task)
    sums = placed.groupBy(F.col(group).alias("_group"), F.col("_task").alias("_t")).agg(F.count("*").alias("_sum"))
    before = sums.select("_group", "_t", (F.sum("_sum").over(Window.partitionBy("_group").orderBy("_t")) - F.col("_sum")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(group, "_task").orderBy("_place")) - 1
    joined = placed.withColumn("_local", local).join(before, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_t")))
    return joined.withColumn(name, F.col("_local") + F.col("_before")).drop("_place", "_task", "_group", "_t", "_before", "_local")
