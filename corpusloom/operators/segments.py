"""Proof traces: segments of (state, step) pairs, and their rendering as training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.running import running_sum

KINDS = ("lemma ", "theorem ")


def segments_of(pairs: Column) -> Column:
    """Split an array of [state, step]: a segment begins at each empty state, and at the first pair."""
    n = F.size(pairs)
    begins = F.filter(F.transform(pairs, lambda p, k: F.when((k == 0) | (F.get(p, F.lit(0)) == ""), k)), lambda k: k.isNotNull())
    return F.transform(begins, lambda b, j: F.slice(pairs, b + 1, F.coalesce(F.get(begins, j + 1), n) - b))


def render(segment: Column) -> Column:
    """[STATEMENT] with the first step, then every state with its step."""
    rest = F.transform(F.slice(segment, 2, F.greatest(F.size(segment), F.lit(1))), lambda p: F.concat(F.lit("\n[PROOF STATE]\n"), F.get(p, F.lit(0)), F.lit("\n[PROOF STEP]\n"), F.get(p, F.lit(1))))
    return F.concat(F.lit("[STATEMENT]\n"), F.get(F.get(segment, F.lit(0)), F.lit(1)), F.array_join(rest, ""))


def proofs(traces: DataFrame, pairs: str = "translations", kinds=KINDS) -> DataFrame:
    """(file, position, proof, length) of every segment whose first step is of one of the kinds; no shuffle."""
    rows = traces.where(F.col(pairs).isNotNull()).select("file", F.posexplode(segments_of(F.col(pairs))).alias("position", "segment"))
    first = F.get(F.get("segment", F.lit(0)), F.lit(1))
    wanted = F.lit(False)
    for k in kinds:
        wanted = wanted | F.startswith(first, F.lit(k))
    return rows.where(wanted).select("file", "position", render(F.col("segment")).alias("proof"), (F.size("segment") - 1).alias("length"))


def numbered_segments(rows: DataFrame, group: str, order: str, begins: Column) -> DataFrame:
    """rows with segment, the number of rows up to this one in the group that begin a segment."""
    return running_sum(rows, group, order, begins.cast("bigint"), "segment")
