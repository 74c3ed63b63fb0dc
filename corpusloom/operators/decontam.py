"""Removal of held-out theorems: documents that contain one, or the passages that state them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import without_part
from corpusloom.operators import substrings
from corpusloom.session import stored

#: Held-out sets beyond this many bytes are not broadcast.
BROADCAST_BYTES = 32 << 20


def _small(df: DataFrame, size: str | Column) -> DataFrame:
    """df, to be broadcast if the sum of size (of a column's bytes, if it is a name) allows it."""
    size = df.agg(F.sum(F.octet_length(size) if isinstance(size, str) else size)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def without_containing(docs: DataFrame, held_out: DataFrame, text: str = "text", needle: str = "text") -> DataFrame:
    """docs that contain no held-out statement; empty statements are ignored and null texts kept.

    Statements of any length meet texts by an equal window (see substrings), and only texts that have one are
    searched. A pair of them is known by the text's hash; as each is searched in the end, no collision matters.
    """
    needles = stored(held_out.select(F.col(needle).alias("needle")).where("needle <> ''").distinct(), "statements")
    met = stored(substrings.candidates(docs, text, needles), "texts-with-anchors")
    return docs.join(_small(met, "needle").toDF("_text", "_needle"), (F.xxhash64(text) == F.col("_text")) & F.contains(F.col(text), F.col("_needle")), "left_anti")


def theorem_needles(held_out: DataFrame, strict: bool = False) -> DataFrame:
    """(file, order, needle) from (file, name, rank): how a theorem of that name may begin in that file.

    Of a dotted name, beginnings are tried from its last part on, short of the whole name; strict
    adds the whole. order tells the group (name and keyword), in which only the first hit counts.
    """
    parts = F.split("name", r"\.")
    most = F.size(parts) - (0 if strict else 1)
    rows = held_out.select("file", "rank", parts.alias("parts"), F.explode(F.when(most > 0, F.sequence(F.lit(1), most))).alias("k"), F.lit("").alias("_"))
    word = F.posexplode(F.array(F.lit("theorem "), F.lit("lemma "))).alias("which", "word")
    rows = rows.select("file", "rank", "k", "parts", word)
    tail = F.array_join(F.slice("parts", F.size("parts") - F.col("k") + 1, F.col("k")), ".")
    return rows.select("file", F.struct((F.col("rank") * 2 + F.col("which")).alias("group"), "k", F.concat("word", tail, F.lit(" ")).alias("needle")).alias("needle"))


def one_per_file(names: DataFrame) -> DataFrame:
    """(file, name, rank) with the last name of each file, at the rank of its first."""
    return names.groupBy("file").agg(F.max_by("name", "rank").alias("name"), F.min("rank").alias("rank"))


def without_theorems(docs: DataFrame, needles: DataFrame, key: str, text: str, path: str, until: str = "\n\n") -> DataFrame:
    """docs less the passages of held-out theorems of their files, and was_transformed.

    Distinct paths meet the files that they contain, then the files' needles, and documents join the list of
    their path, so no text is shuffled while the lists are small. Needles are applied in order; only needles are gathered,
    and a path has as many as the held-out set has for its files.
    """
    paths = docs.select(F.col(path).alias("_path")).distinct()
    files = substrings.occurrences(paths, "_path", needles.select("file"), "file").toDF("_path", "file")
    lists = files.join(needles.select("file", "needle"), "file").groupBy("_path").agg(F.array_sort(F.collect_list("needle")).alias("_needles"))
    lists = stored(lists, "needles-of-paths")
    size = F.transform("_needles", lambda n: F.octet_length(n["needle"]) + 16)
    lists = _small(lists, F.octet_length("_path") + F.aggregate(size, F.lit(0), lambda a, b: a + b))
    joined = docs.join(lists, F.col(path) == F.col("_path"), "left").drop("_path")

    def step(state, n):
        cut, had = without_part(state["text"], n["needle"], until)
        hit = had & (state["done"] != n["group"])
        return F.struct(
            F.when(hit, cut).otherwise(state["text"]).alias("text"), F.when(hit, n["group"]).otherwise(state["done"]).alias("done"), (state["was"] | hit).alias("was")
        )

    start = F.struct(F.col(text).alias("text"), F.lit(-1).cast("bigint").alias("done"), F.lit(False).alias("was"))
    folded = F.aggregate(F.coalesce("_needles", F.array().cast("array<struct<group:bigint,k:int,needle:string>>")), start, step)
    return joined.withColumn("_folded", folded).withColumn(text, F.col("_folded.text")).withColumn("was_transformed", F.col("_folded.was")).drop("_folded", "_needles")


def _made_by_cuts(name: Column, until: str) -> Column:
    """Whether a cut can make the name occur where it didn't: it has until, or ends in its beginning, after its first character."""
    ends = [F.endswith(name, F.lit(until[:k])) & (F.char_length(name) > k) for k in range(1, len(until))]
    inside = F.locate(until, name, 2) > 0
    return reduce(Column.__or__, ends, inside)


def without_statements(docs: DataFrame, names: DataFrame | list[str], text: str, until: str = "\n\n", name: str = "name") -> DataFrame:
    """docs less, for each name in sorted order, the passage from its first occurrence on; and was_transformed.

    names is a list, or a table with a column of names. A text is searched for all names at once (see substrings), and only those that it has
    are applied, as well as the few that a cut may put together from what is before and behind it.
    """
    if isinstance(names, list):
        names, name = docs.sparkSession.createDataFrame([(n,) for n in names], "name string"), "name"
    needles = stored(names.select(F.col(name).alias("needle")).where("needle <> ''").distinct(), "names")
    listed = substrings.as_list(needles, "needle")
    if listed is not None:
        docs = docs.withColumn("_names", substrings.contained(F.col(text), listed))
    else:
        met = stored(substrings.candidates(docs, text, needles), "texts-with-anchors")
        met = _small(stored(met.groupBy("text_hash").agg(F.collect_list("needle").alias("_names")), "names-of-texts"), F.size("_names") * 64)
        docs = docs.join(met, F.xxhash64(text) == F.col("text_hash"), "left").drop("text_hash")
    made = [r[0] for r in needles.where(_made_by_cuts(F.col("needle"), until)).collect()]
    start = F.struct(F.col(text).alias("text"), F.lit(False).alias("was"))

    def step(state, name):
        cut, had = without_part(state["text"], name, until)
        return F.struct(cut.alias("text"), (state["was"] | had).alias("was"))

    found = F.array_union("_names", F.array(*map(F.lit, made))) if made else F.col("_names")
    found = F.when(F.size("_names") > 0, F.array_sort(found)).otherwise(F.array().cast("array<string>"))
    folded = docs.withColumn("_folded", F.aggregate(found, start, step))
    return folded.withColumn(text, F.col("_folded.text")).withColumn("was_transformed", F.col("_folded.was")).drop("_folded", "_names")


def statement_names(statements: DataFrame, column: str = "statement") -> DataFrame:
    """Distinct beginnings of held-out statements, up to their first colon, with it."""
    return statements.select(F.concat(F.split_part(F.col(column), F.lit(":"), F.lit(1)), F.lit(":")).alias("name")).distinct()
