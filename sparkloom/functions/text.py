"""Scalar text functions as column expressions: titles, keys, Markdown normal form, accents."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python sees it: Java's Unicode class and the four information separators.
SPACE = r"[\s\x1c-\x1f]"
_OUTLET = rf"(?U){SPACE}+-{SPACE}+[^-]{{2,60}}$"


def collapse(c: Column) -> Column:
    """Runs of white space become one space; none at either end."""
    return F.regexp_replace(F.regexp_replace(c, rf"(?U){SPACE}+", " "), "^ | $", "")


def clean_string(c: Column) -> Column:
    """Collapsed text; null instead of an empty one."""
    return F.nullif(collapse(c), F.lit(""))


def title_expression(c: Column) -> Column:
    """A headline without its outlet's suffix, collapsed. The text must be in composed form (NFC)."""
    return collapse(F.regexp_replace(c, _OUTLET, ""))


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Composed form; there is no built-in for it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def composed(c: Column) -> Column:
    """The text in composed form (NFC). Only texts that may change are sent to Python; for the others a null is.

    Characters below U+0300 are composed already, so that texts of them alone are their own NFC.
    """
    return F.coalesce(nfc(F.when(c.rlike(r"[^\x{0}-\x{2ff}]"), c)), c)


def normalize_titles(df: DataFrame, column: str) -> DataFrame:
    """Titles in normal form."""
    return df.withColumn(column, composed(F.col(column))).withColumn(column, title_expression(F.col(column)))


@cache
def _plain_letters() -> tuple[str, str, dict[str, str]]:
    """Letters whose folded form without marks is another letter, that letter, and those that become several.

    By rule, over all characters but Hangul syllables, which stand for themselves.
    """
    source, target, several = [], [], {}
    for code in range(0x41, 0x20000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        c = chr(code)
        key = "".join(x for x in unicodedata.normalize("NFD", c.casefold()) if unicodedata.category(x) != "Mn")
        if key != c and len(key) == 1:
            source.append(c)
            target.append(key)
        elif len(key) > 1:
            several[c] = key
    return "".join(source), "".join(target), several


def dedupe_key(c: Column) -> Column:
    """Case and accents removed, collapsed: equal for titles that differ in these alone."""
    source, target, several = _plain_letters()
    out = F.translate(c, source, target)
    whole = out
    for a, b in several.items():
        whole = F.replace(whole, F.lit(a), F.lit(b))
    out = F.when(out.rlike("[" + "".join(several) + "]"), whole).otherwise(out)
    return collapse(F.regexp_replace(out, r"\p{Mn}", ""))


@cache
def _unaccented() -> tuple[str, str]:
    """Small letters that become another single character without their marks (compatible ones too), and those, by rule over all characters."""
    pairs = []
    for code in range(0xA0, 0x20000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != c and plain.lower() == plain:
            pairs.append((c, plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(c: Column) -> Column:
    """Lower case without accents, letters of other kinds kept (as the tf-idf analyser wants). Texts of ASCII alone are lower-cased only."""
    small = F.lower(c)
    plain = F.regexp_replace(F.translate(small, *_unaccented()), r"\p{Mn}", "")
    return F.when(small.rlike(r"[^\x00-\x7F]"), plain).otherwise(small)


def normal_lines(c: Column) -> Column:
    """Line ends are one newline, no white space before them, one empty line at most, trimmed."""
    out = F.regexp_replace(c, r"\r\n?", "\n")
    out = F.regexp_replace(out, r"(?U)[\s\x1c-\x1f&&[^\n]]+(?=\n|\z)", "")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return F.regexp_replace(out, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def normalize_markdown(c: Column) -> Column:
    """Composed text with normal lines."""
    return normal_lines(composed(c))
