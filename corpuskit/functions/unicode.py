"""Text repairs that Spark has no expressions for, as Arrow functions on whole columns."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .text import strip_tags

_QUOTES = {0x2018: "'", 0x2019: "'", 0x201A: "'", 0x201B: "'", 0x201C: '"', 0x201D: '"', 0x201E: '"', 0x201F: '"'}
_LIGATURES = {0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl", 0xFB05: "st", 0xFB06: "st", 0x0132: "IJ", 0x0133: "ij"}
_WIDE = {0xFF01 + i: chr(0x21 + i) for i in range(94)} | {0x3000: " "}
_CONTROL = {c: None for c in (*range(0x00, 0x09), 0x0B, *range(0x0E, 0x20), *range(0x7F, 0x80), 0xFEFF)}
_FIX = _QUOTES | _LIGATURES | _WIDE | _CONTROL
_BREAKS = re.compile("\r\n|\r|\u2028|\u2029|\u0085")
_MOJIBAKE = re.compile("[\u00c2-\u00f4][\u0080-\u00bf]")


def repair(text: str) -> str:
    """UTF-8 that was read as Latin-1, put right if the outcome is valid; otherwise the text itself."""
    if not _MOJIBAKE.search(text):
        return text
    try:
        return text.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return text


def fix(text: str) -> str:
    """Repairs encoding, quotes, ligatures, widths, control characters and line breaks, then composes."""
    return unicodedata.normalize("NFC", _BREAKS.sub("\n", repair(text)).translate(_FIX))


def _column(f):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return run


_nfc = _column(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t))
_repair = _column(repair)
_fix = _column(fix)
_unescape = _column(html.unescape)


def nfc(c: Column) -> Column:
    return _nfc(c)


def fix_mojibake(c: Column) -> Column:
    return _repair(c)


def normalize_unicode(c: Column) -> Column:
    return _fix(c)


def clean_html(c: Column) -> Column:
    """Entities decoded, then tags stripped; texts without "&" don't leave the JVM's fast path."""
    return strip_tags(_unescape(c))


def fix_all(texts: Column, unicode: bool = True, tags: bool = True) -> Column:
    """An array of texts with Unicode normalised, and entities decoded and tags stripped, as asked for."""
    tag = re.compile("<[^>]*>")

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        t = fix(t) if unicode else t
        return tag.sub("", html.unescape(t)) if tags else t

    @F.pandas_udf(ArrayType(StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda ts: None if ts is None else [one(t) for t in ts])

    return run(texts)
