"""Multi-party chat formatting by perspective rotation, in DataFrame operations only.

Every participant of a conversation gets a rendering of it in which that participant is the
assistant, everyone else is a named user, and the mask covers what the assistant says. System
turns stay system turns in every rendering and take no part.

A long conversation is rendered in parts of part_turns consecutive turn numbers, so no group
grows with a conversation; turns that share a number are split further by rank. For the ranks, equal rows are
counted first, and what is distinct is dealt to ranges of the whole order (conversation, part, turn, role, text), so
no conversation, turn number or beginning of a text is a single task; counts of the ranges before are added, and repeats are
expanded last. A part without a turn of its assistant still appears, with an empty mask.

The marks that open and close a turn, where they occur in a text or name, get a backslash after the
``<``, and line ends in a name become spaces, so no speaker can forge a turn.

Turns are ordered by turn number (null first), then role, then text. Repeated rows are repeated
turns. A null role is the participant ``unknown``; a null text is empty; rows with a null
conversation id form one conversation. A conversation of system turns only has no participants
and no rendering. Other columns are ignored. A row holds one rendered part, hence one very long text whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import stored, table

SYSTEM, ASSISTANT, USER, UNKNOWN = "system", "assistant", "user", "unknown"
PART_TURNS = 256
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _inert(text: Column) -> Column:
    """The text with its marks made inert."""
    for mark in (BEGIN, END):
        text = F.replace(text, F.lit(mark), F.lit(mark.replace("<", "<\\")))
    return text


def _head(role: Column, perspective: Column) -> Column:
    """The line that opens a turn."""
    user = F.concat(F.lit(f"{BEGIN}{USER} name="), _inert(F.translate(role, "\r\n", "  ")), F.lit("\n"))
    return F.when(role == perspective, F.lit(f"{BEGIN}{ASSISTANT}\n")).when(role == SYSTEM, F.lit(f"{BEGIN}{SYSTEM}\n")).otherwise(user)


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """One row for each conversation, participant and part.

    Columns: conv_id, perspective, part (block of turn numbers), subpart (only where more than
    part_turns rows share a block), n_turns, n_targets, rendered, and mask: comma-joined
    begin:end of what counts for the loss (the assistant's words and its end mark), in
    characters of rendered.
    """
    rows = turns.select(
        F.col("conv_id"), F.floor(F.col("turn") / part_turns).alias("part"), "turn",
        F.coalesce(F.col("role"), F.lit(UNKNOWN)).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    # distinct rows in ranges of the order; stored, as sampling another time might cut the ranges elsewhere
    order = ["conv_id", "part", "turn", "role", "text"]
    dealt = rows.groupBy(*order).agg(F.count("*").alias("copies")).repartitionByRange(*order).withColumn("dealt_to", F.spark_partition_id())
    dealt = stored(dealt, "turns")
    here = ["conv_id", "part", "dealt_to"]
    sizes = dealt.groupBy(*here).agg(F.sum("copies").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("conv_id", "part").orderBy("dealt_to")) - F.col("n")
    sizes = sizes.select(*(F.col(c).alias(f"{c}_") for c in here), ahead.alias("ahead"))
    local = F.sum("copies").over(Window.partitionBy(*here).orderBy("turn", "role", "text")) - F.col("copies")
    ranked = dealt.withColumn("rank", local).join(sizes, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in here])
    first = F.col("ahead") + F.col("rank")
    last = first + F.col("copies") - 1
    blocks = F.explode(F.sequence(F.floor(first / part_turns), F.floor(last / part_turns))).alias("subpart")
    rows = ranked.select("conv_id", "part", "turn", "role", "text", first.alias("first"), last.alias("last"), blocks)
    here = F.least("last", (F.col("subpart") + 1) * part_turns - 1) - F.greatest("first", F.col("subpart") * part_turns) + 1
    rows = rows.withColumn("copies", here.cast("int"))
    listed = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "copies")))
    repeated = F.flatten(F.transform(listed, lambda t: F.array_repeat(F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text")), t["copies"])))
    parts = rows.groupBy("conv_id", "part", "subpart").agg(repeated.alias("turns"))
    said = turns.select(F.col("conv_id").alias("whose"), F.coalesce(F.col("role"), F.lit(UNKNOWN)).alias("perspective"))
    people = said.where(F.col("perspective") != SYSTEM).distinct()
    seen = parts.join(people, F.col("conv_id").eqNullSafe(F.col("whose"))).select("conv_id", "part", "subpart", "turns", "perspective")
    me = F.col("perspective")
    heads = F.transform("turns", lambda t: _head(t["role"], me))
    seen = seen.withColumn("heads", heads)
    pieces = F.zip_with("turns", "heads", lambda t, h: F.struct((t["role"] == me).alias("mine"), F.char_length(h).alias("head"), F.concat(h, _inert(t["text"]), F.lit(f"{END}\n")).alias("piece")))
    seen = seen.select("conv_id", "perspective", "part", "subpart", pieces.alias("pieces"))
    # a running sum of lengths: where each piece ends
    ends = F.aggregate("pieces", F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.char_length(p["piece"]))))
    seen = seen.withColumn("ends", ends)
    spans = F.transform("pieces", lambda p, k: F.when(p["mine"], F.concat(F.get("ends", k) + p["head"], F.lit(":"), F.get("ends", k + 1) - 1)))
    return seen.select(
        "conv_id", "perspective", "part", "subpart", F.size("pieces").cast("bigint").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["mine"])).cast("bigint").alias("n_targets"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("rendered"), F.array_join(spans, ",").alias("mask"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH r AS (
  SELECT conv_id, CAST(floor(turn / 256.0) AS BIGINT) AS part, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM r),
people AS (SELECT DISTINCT conv_id AS whose, role AS perspective FROM r WHERE role <> 'system'),
h AS (
  SELECT conv_id, perspective, part, CAST(floor(pos / 256.0) AS BIGINT) AS subpart, pos, role, text,
    CASE WHEN role = perspective THEN '<|im_start|>assistant' || chr(10)
         WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
         ELSE '<|im_start|>user name=' || replace(replace(translate(role, chr(13) || chr(10), '  '), '<|im_start|>', '<\\|im_start|>'), '<|im_end|>', '<\\|im_end|>') || chr(10) END AS head
  FROM n JOIN people ON conv_id IS NOT DISTINCT FROM whose),
p AS (SELECT *, head || replace(replace(text, '<|im_start|>', '<\\|im_start|>'), '<|im_end|>', '<\\|im_end|>') || '<|im_end|>' || chr(10) AS piece FROM h),
e AS (
  SELECT *, CAST(coalesce(sum(length(piece)) OVER (
    PARTITION BY conv_id, perspective, part, subpart ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun
  FROM p)
SELECT conv_id, perspective, part, subpart, count(*) AS n_turns, count(*) FILTER (WHERE role = perspective) AS n_targets,
  string_agg(piece, '' ORDER BY pos) AS rendered,
  coalesce(string_agg(CASE WHEN role = perspective THEN (begun + length(head)) || ':' || (begun + length(piece) - 1) END, ',' ORDER BY pos), '') AS mask
FROM e GROUP BY conv_id, perspective, part, subpart
"""
