"""Column expressions over text. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Python's str.isspace() accepts, as a class that Java and RE2 read alike.
WHITESPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


#: The same characters, as a string.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def digits(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[0-9]"))


def solid_length(text: Column) -> Column:
    """Characters that aren't white space."""
    return F.char_length(F.translate(text, SPACES, ""))


def numerical_density(text: Column) -> Column:
    """ASCII digits among characters that aren't white space; 0 for blank text."""
    return digits(text) / F.greatest(F.lit(1), solid_length(text))


def dense(text: Column, most: float) -> Column:
    """numerical_density(text) <= most; true for blank text. Only of texts with a digit, white space is counted."""
    return F.when(digits(text) == 0, True).otherwise(digits(text) <= most * solid_length(text))


def is_blank(text: Column) -> Column:
    """No character but white space; the search ends at the first other one."""
    return ~text.rlike(f"[^{WHITESPACE[1:]}")


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    found = F.lit(False)
    for k in keywords:
        found = found | F.contains(text, F.lit(k))
    return found


def found_keywords(text: Column, keywords: Iterable[str]) -> Column:
    """Those keywords that occur, in the given order."""
    return F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(text, k))


def count_of(text: Column, what: str) -> Column:
    """Occurrences, not overlapping."""
    return F.floor((F.char_length(text) - F.char_length(F.replace(text, F.lit(what), F.lit("")))) / len(what))


def without_part(text: Column, query: Column, until: str) -> tuple[Column, Column]:
    """The text less what lies from the first query up to the next until, or to the end; and whether it had one."""
    at = F.call_function("locate", query, text)
    rest = F.call_function("locate", F.lit(until), text, at)
    whole = F.lit(2**31 - 1)
    cut = F.concat(F.substring(text, F.lit(1), at - 1), F.when(rest > 0, F.substring(text, rest, whole)).otherwise(""))
    return F.when(at > 0, cut).otherwise(text), at > 0


# The patterns of what is stripped, and of file names, below.
def without_images(text: Column) -> Column:
    """Less Markdown images, with or without a title."""
    return F.regexp_replace(text, r'(?d)!\[[^\]]*\]\(.*?(?:".*")?\)', "")


def without_embeds(text: Column) -> Column:
    """Less img tags, and video, script and iframe elements."""
    text = F.regexp_replace(text, r"<img[^>]*>", "")
    return F.regexp_replace(text, r"(?s)<video.*?</video>|<script.*?</script>|<iframe.*?</iframe>", "")


def first_group(text: Column, pattern: str) -> Column:
    """The first group of the first match, or null."""
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1))


def theory_of(file: Column) -> Column:
    """The theory that a proof trace's file name tells, or null."""
    return first_group(file, r"2022-12-06_thys_(.*?)\.thy_output\.json")


def module_name(path: Column, suffix: str = ".lean") -> Column:
    """a/b/C.lean becomes a.b.C."""
    return F.translate(F.regexp_replace(path, suffix.replace(".", r"\.") + "$", ""), "/", ".")
