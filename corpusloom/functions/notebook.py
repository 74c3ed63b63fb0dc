"""Notebooks to Markdown.

Of a cell with an image or an error among its outputs, all outputs go. Markdown cells are taken
as they are, code is fenced, text outputs are indented. Images and embedded elements are then
stripped. What can't be read as a notebook is marked as not converted.

All of it is column expressions over VARIANT, so notebooks stay in the JVM. Only what strict JSON does not
allow but many writers do (NaN, a key twice in one object), and what is larger than a VARIANT can be, is read in Python, by the
function of the same rules below; it sees nulls for all other rows.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import without_embeds, without_images


def _text(value) -> str:
    return "".join(value) if isinstance(value, list) else value or ""


def _unwanted(output: dict) -> bool:
    image = "output_type" in output and "data" in output and output["data"].get("image/png")
    return bool(image) or ("ename" in output and "traceback" in output)


def _shown(output: dict) -> str | None:
    """What an output adds to the page as text."""
    if output.get("output_type") == "stream":
        return _text(output.get("text"))
    data = output.get("data") or {}
    for kind in ("text/markdown", "text/latex"):
        if kind in data:
            return "\0" + _text(data[kind])  # as it is, not indented
    return _text(data["text/plain"]) if "text/plain" in data else None


def _cells(book: dict) -> list[dict]:
    """Cells in the form of version 4; version 3 keeps them in worksheets and names some parts otherwise."""
    if "cells" in book:
        return book["cells"]
    old = [c for sheet in book["worksheets"] for c in sheet["cells"]]
    for c in old:
        c.setdefault("source", c.get("input", ""))
        if c.get("cell_type") == "heading":
            c["cell_type"], c["source"] = "markdown", "#" * int(c.get("level", 1)) + " " + _text(c["source"])
        for o in c.get("outputs", []):
            if o.get("output_type") == "pyerr":
                o["output_type"] = "error"
            if "png" in o or "text" in o and o.get("output_type") != "stream":
                o["data"] = {"image/png": o.get("png"), "text/plain": o.get("text", "")}
    return old


def markdown_of(raw: str | None) -> str | None:
    """The notebook as Markdown, or None if it isn't one."""
    try:
        book = json.loads(raw)
        language = (book.get("metadata", {}).get("language_info") or {}).get("name", "") or ("python" if "kernelspec" in book.get("metadata", {}) else "")
        out = []
        for cell in _cells(book):
            source = _text(cell["source"])
            if cell["cell_type"] == "code":
                outputs = cell.get("outputs", [])
                if any(map(_unwanted, outputs)):
                    outputs = []
                out.append(f"```{language}\n{source}\n```")
                for shown in map(_shown, outputs):
                    if shown and shown != "\0":
                        out.append(shown[1:] if shown[0] == "\0" else "\n".join(f"    {line}" for line in shown.rstrip("\n").split("\n")))
            else:
                out.append(source)
        return "\n\n".join(out) + "\n"
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


@F.pandas_udf(T.StringType())
def _read_in_python(raw: pd.Series) -> pd.Series:
    return raw.map(markdown_of)


def _get(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{path}" if path.isidentifier() else f"$['{path}']", kind)


def _list(value: Column, path: str) -> Column:
    return F.coalesce(_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def _is_text(value: Column) -> Column:
    """Whether a VARIANT is a string, a list of strings, or null; a missing one is too."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    return kind.isin("STRING", "ARRAY<STRING>", "ARRAY<VOID>", "VOID")


def _joined(value: Column) -> Column:
    """The text of a string or of a list of lines; empty for anything else."""
    kind = F.schema_of_variant(value)
    whole = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    return F.coalesce(whole.when(kind == "ARRAY<STRING>", F.array_join(F.try_variant_get(value, "$", "array<string>"), "")), F.lit(""))


def _png(output: Column, old: Column) -> Column:
    data = _get(output, "data")
    return F.coalesce(_get(data, "image/png"), F.when(old, _get(output, "png")))


def _drops_outputs(output: Column, old: Column) -> Column:
    """Whether an output is an image or an error, so that all outputs of its cell go."""
    typed = _get(output, "output_type").isNotNull()
    failed = _get(output, "ename").isNotNull() & _get(output, "traceback").isNotNull()
    return (typed & (_joined(_png(output, old)) != "")) | failed


def _output_text(output: Column, old: Column) -> Column:
    """What an output adds to the page; null for nothing."""
    data = _get(output, "data")
    kind = _get(output, "output_type", "string")
    plain = F.coalesce(_get(data, "text/plain"), F.when(old & (F.coalesce(kind, F.lit("")) != "stream"), _get(output, "text")))
    as_is = F.coalesce(_get(data, "text/markdown"), _get(data, "text/latex"))
    text = F.when(kind == "stream", _joined(_get(output, "text"))).otherwise(_joined(plain))
    lines = F.replace(F.regexp_replace(text, r"\n+\z", ""), F.lit("\n"), F.lit("\n    "))
    indented = F.when(text != "", F.concat(F.lit("    "), lines))
    return F.when((kind != "stream") & as_is.isNotNull(), F.nullif(_joined(as_is), F.lit(""))).otherwise(indented)


def _cell_parts(cell: Column, language: Column, old: Column) -> Column:
    """The pieces of a page that a cell makes; null if it is no cell."""
    kind, given = _get(cell, "cell_type", "string"), _get(cell, "source")
    source = F.coalesce(given, F.when(old, _get(cell, "input")))
    text = _joined(source)
    heading = F.concat(F.repeat(F.lit("#"), F.coalesce(_get(cell, "level", "int"), F.lit(1))), F.lit(" "), text)
    outputs = _list(cell, "outputs")
    dropped = F.exists(outputs, lambda o: _drops_outputs(o, old))
    shown = F.filter(F.transform(outputs, lambda o: _output_text(o, old)), lambda x: x.isNotNull())
    code = F.concat(F.lit("```"), language, F.lit("\n"), text, F.lit("\n```"))
    parts = F.when(kind == "code", F.concat(F.array(code), F.when(dropped, F.array().cast("array<string>")).otherwise(shown)))
    parts = parts.when(old & (kind == "heading"), F.array(heading)).otherwise(F.array(text))
    return F.when(kind.isNotNull() & (given.isNotNull() | old) & _is_text(source), parts)


def to_markdown(raw: Column) -> Column:
    """The notebook as Markdown, or null if it isn't one."""

    def page(book: Column) -> Column:
        new = _get(book, "cells", "array<variant>")
        sheets = F.flatten(F.transform(_get(book, "worksheets", "array<variant>"), lambda s: _get(s, "cells", "array<variant>")))
        old = _get(book, "cells").isNull()
        meta = _get(book, "metadata")
        named = F.nullif(_get(_get(meta, "language_info"), "name", "string"), F.lit(""))
        language = F.coalesce(named, F.when(_get(meta, "kernelspec").isNotNull(), "python"), F.lit(""))
        parts = F.transform(F.when(old, sheets).otherwise(new), lambda c: _cell_parts(c, language, old))
        return F.when(F.forall(parts, lambda p: p.isNotNull()), F.concat(F.array_join(F.flatten(parts), "\n\n"), F.lit("\n")))

    # bound as a lambda's variable, so a notebook is parsed once
    return F.element_at(F.transform(F.array(F.try_parse_json(raw)), page), 1)


def stripped(markdown: Column) -> Column:
    return without_embeds(without_images(markdown))


def convert_notebooks(df: DataFrame, content: str = "content") -> DataFrame:
    """content as stripped Markdown and converted; an unreadable notebook keeps its content."""
    raw = F.col(content)
    made = df.withColumn("_markdown", to_markdown(raw)).withColumn("_loose", _read_in_python(F.when(F.try_parse_json(raw).isNull(), raw)))
    made = made.withColumn("_markdown", F.coalesce("_markdown", "_loose"))
    converted = F.col("_markdown").isNotNull()
    return made.withColumn("converted", converted).withColumn(content, F.when(converted, stripped(F.col("_markdown"))).otherwise(raw)).drop("_markdown", "_loose")
