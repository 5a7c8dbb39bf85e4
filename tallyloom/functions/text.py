"""Token and text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .fixed_values import STOP_WORDS


def raw_tokens(text: Column) -> Column:
    """Lower-case ASCII word tokens; a form of the word pattern that is equal in every regex engine."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}_.]+")
    stripped = F.transform(parts, lambda t: F.btrim(t, F.lit(".")))
    return F.filter(stripped, lambda t: t.rlike("^[a-z0-9._]+$"))


def token_set(text: Column) -> Column:
    """Distinct tokens of a text without stop words."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.array_except(F.array_distinct(raw_tokens(F.coalesce(text, F.lit("")))), stop)


def split_clean(text: Column, pattern: str) -> Column:
    """Split on a pattern, trim the pieces, drop the empty ones."""
    return F.filter(F.transform(F.split(text, pattern), lambda s: trim_space(s)), lambda s: F.length(s) > 0)


def trim_space(c: Column) -> Column:
    """Strip blanks, tabs and line ends on both sides."""
    return F.regexp_replace(c, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def escape_regex(word: str) -> str:
    return re.sub(r"([.^$*+?()\[\]{}|\\-])", r"\\\1", word)


def any_keyword(words: list[str]) -> str:
    """Alternation of literal keywords for rlike."""
    return "|".join(escape_regex(w) for w in words)


def fixed(c, digits: int) -> Column:
    """Number with thousands separators and a fixed number of digits."""
    return F.format_number(F.round(c, 6), digits)


def plain(c, digits: int) -> Column:
    """Number with a fixed number of digits and no separators."""
    return F.regexp_replace(F.format_number(F.round(c, 6), digits), ",", "")
