"""Canonical text as column expressions. White space and line ends are those of Python's str, not of Java's regex."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What Python calls white space and line ends, and the characters that normalisation deletes.
SPACE = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
ZERO_WIDTH = "​‌‍﻿"


@F.pandas_udf(StringType())
def _nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFC", v))


@F.pandas_udf(StringType())
def _folded(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None else v.casefold())


@F.pandas_udf(StringType())
def unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: html.unescape(v) if v and "&" in v else v)


def nfc(text: Column) -> Column:
    """Python gets texts outside ASCII, and a null for each of the others: a function runs on every row, whatever
    condition stands around it."""
    other = F.when(text.rlike("[^\\x00-\\x7f]"), text)
    return F.coalesce(_nfc(other), text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+\\z", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+\\z", "")


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"[{SPACE}]+", " "))


def normalize(text: Column, compose: bool = True) -> Column:
    """Composed, without zero-width characters, white space collapsed and stripped. ``compose=False`` is for use inside
    array functions, where no Python function may run: compose the whole text before."""
    bare = F.translate(nfc(text) if compose else text, ZERO_WIDTH, "")
    return squeeze(bare)


def speaker_key(text: Column) -> Column:
    plain = normalize(text)
    return F.coalesce(_folded(F.when(plain.rlike("[^\\x00-\\x7f]"), plain)), F.lower(plain))


def merge_lines(lines: Column) -> Column:
    """Lines of composed text, each normalised, the empty ones dropped, joined by a space."""
    return F.array_join(F.filter(F.transform(lines, lambda x: normalize(x, compose=False)), lambda x: x != ""), " ")


def split_lines(text: Column) -> Column:
    """What str.splitlines gives: no line after a final line end, none in an empty text."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def without_qualifier(raw: Column) -> Column:
    """A trailing "(...)", then a trailing "[...]", cut off at its last opener, where something remains."""
    out = normalize(raw)
    for opener, closer in (("(", ")"), ("[", "]")):
        head = strip(F.regexp_extract(out, f"(?s)^(.*)\\{opener}", 1))
        out = F.when(out.endswith(closer) & out.contains(opener) & (head != ""), head).otherwise(out)
    return out


def clock_seconds(stamp: Column) -> Column:
    """Seconds of M:SS or H:MM:SS; the parts are not limited to 59."""
    return F.aggregate(F.split(stamp, ":"), F.lit(0), lambda acc, part: acc * 60 + part.cast("int"))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)
