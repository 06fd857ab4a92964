"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(text: Column) -> Column:
    """The digits of a text; any script's digits count, as in Unicode-aware ``\\D``."""
    return F.regexp_replace(text, r"(?U)\D+", "")


def strip_extension(name: Column) -> Column:
    """File name without its last extension; leading dots belong to the stem."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def has_suffix(name: Column, suffixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [name.endswith(s) for s in suffixes])


# The characters stripped as whitespace.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
FENCE_START, FENCE_END = "```json", "```"


def strip_fence(text: Column) -> Column:
    """JSON text out of a fenced code block: prefix, then suffix, then outer whitespace."""
    rest = F.substring(text, F.lit(len(FENCE_START) + 1), F.length(text))
    opened = F.when(text.startswith(FENCE_START), rest).otherwise(text)
    inner = F.substring(opened, F.lit(1), F.length(opened) - len(FENCE_END))
    closed = F.when(opened.endswith(FENCE_END), inner).otherwise(opened)
    return F.btrim(closed, F.lit(WHITESPACE))


def notice_url(notice_id: Column, base: str) -> Column:
    return F.concat(F.lit(base), F.coalesce(notice_id.cast("string"), F.lit("")))


def joined(*parts: Column | str) -> Column:
    """Concatenation that reads NULL as empty text."""
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    )


def contains_all(text: Column, keywords: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [text.contains(k) for k in keywords], F.lit(True))


def tokens(text: Column) -> Column:
    """Distinct lower-case words of a whole text."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_remove(F.array_distinct(words), "")
