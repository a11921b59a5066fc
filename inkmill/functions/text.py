"""Text functions: columns to columns, without Python where the semantics allow."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.batches import bound_batches

#: White space as Unicode has it and the separators U+001C to U+001F.
_EDGE = r"(?U)\A[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z"
_SPACE = r"(?U)[\s\x1C-\x1F]+"
_LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
_NOT_LETTER = r"[^\p{L}\p{Nl}\p{No}]"
#: Characters that a front-matter value can't have unquoted (fixed values).
_QUOTED = r"[:#\[\]{}\"'\n|>&%@`*!,]"


def clean(c: Column) -> Column:
    """Without replacement characters and control characters, but line feeds and tabs; null is ''."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0B-\x1F\uFFFD\uFFFF]", "")


def strip(c: Column) -> Column:
    """Without white space at both ends, as Unicode defines it (``trim`` knows the blank only)."""
    return F.regexp_replace(c, _EDGE, "")


def chars(c: Column) -> Column:
    """Code points of the stripped text."""
    return F.length(strip(c))


def ocr_chars(c: Column) -> Column:
    """Code points without line feeds, stripped."""
    return F.length(strip(F.replace(c, F.lit("\n"), F.lit(""))))


def without_scripts(c: Column) -> Column:
    return F.regexp_replace(c, r"(?is)<(script|style).*?</\1>", "")


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<[^>]+>", " ")


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """All HTML5 character references, those without a semicolon too."""
    return s.map(html.unescape, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_each(s: pd.Series) -> pd.Series:
    return s.map(lambda parts: [html.unescape(p) for p in parts], na_action="ignore")


def squeeze(c: Column) -> Column:
    """Runs of blanks and tabs to one blank, three or more line feeds to two."""
    return F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")


def chapter_text(c: Column) -> Column:
    """Text of one HTML chapter: tags go before references are decoded, so escaped brackets stay."""
    bound_batches()
    return unescape(without_tags(without_scripts(c)))


def chapter_texts(c: Column) -> Column:
    """``chapter_text`` of each element."""
    bound_batches()
    return unescape_each(F.transform(c, lambda x: without_tags(without_scripts(x))))


def page_text(c: Column) -> Column:
    return squeeze(clean(chapter_text(c)))


def excerpt(c: Column, limit: int = 80) -> Column:
    """The first line with eight letters at least, its spaces collapsed, cut to ``limit``; else ''."""
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), _LINE_END), strip)
    rich = F.filter(lines, lambda x: F.length(F.regexp_replace(x, _NOT_LETTER, "")) >= 8)
    return F.coalesce(F.substring(F.regexp_replace(F.get(rich, F.lit(0)), _SPACE, " "), 1, limit), F.lit(""))


def json_string(c: Column) -> Column:
    """A JSON string literal."""
    return F.regexp_extract(F.to_json(F.array(c)), r"(?s)\A\[(.*)\]\z", 1)


def front_matter_value(c: Column) -> Column:
    """As it is, or a JSON string if it is empty, has a special character or edge spaces."""
    return F.when((c == "") | c.rlike(_QUOTED) | (strip(c) != c), json_string(c)).otherwise(c)


@F.pandas_udf(T.StringType())
def size_label(n: pd.Series) -> pd.Series:
    """Ten thousands with one decimal from 10000 on.

    The decimal is rounded as the binary quotient is, which the JVM's formatter doesn't do.
    """
    return n.map(lambda x: None if pd.isna(x) else f"{int(x) / 10000:.1f}万字" if x >= 10000 else f"{int(x)}字")


@F.pandas_udf(T.StringType())
def bytes_label(n: pd.Series) -> pd.Series:
    """Gigabytes with two decimals above 1e9, else whole megabytes."""
    return n.map(lambda x: None if pd.isna(x) else f"{x / 1024**3:.2f}GB" if x > 1e9 else f"{x / 1024**2:.0f}MB")


def occurrences(c: Column, word: str) -> Column:
    """How often ``word`` occurs, without overlaps."""
    if not word:
        raise ValueError("an empty keyword has no count")
    return ((F.length(c) - F.length(F.replace(c, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("int")


def context(body: Column, word: str, width: int = 50) -> Column:
    """The first hit of the lower-case ``word`` with half the width on both sides, in dots; '' without a hit."""
    half = width // 2
    at = F.instr(F.lower(body), word)
    start = F.greatest(F.lit(0), at - (half + 1))
    part = F.substring(body, start + 1, at - 1 + F.lit(len(word) + half) - start)
    return F.when(at > 0, F.concat(F.lit("…"), strip(F.regexp_replace(part, _SPACE, " ")), F.lit("…"))).otherwise("")


def text_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
