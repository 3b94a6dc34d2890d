"""Exact duplicates on normalised text, with the sizes that a Bloom filter for them would have."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import text as T
from ..cleaning import first_of


def bloom_size(n: int = 10_000, p: float = 0.001) -> tuple[int, int]:
    """Bits and hashes of a Bloom filter for n items at false-positive rate p."""
    bits = int(-n * math.log(p) / math.log(2) ** 2) + 1
    return bits, int(bits / n * math.log(2)) + 1


def bloom_size_columns(n: Column, p: Column) -> tuple[Column, Column]:
    bits = F.floor(-n * F.ln(p) / F.pow(F.ln(F.lit(2.0)), 2)) + 1
    return bits, F.floor(bits / n * F.ln(F.lit(2.0))) + 1


def first_by_text(df: DataFrame, text: Column, pos: str = "pos", lower: bool = True, blanks: bool = True) -> DataFrame:
    """The first row of each normalised text. A shuffle of digests decides; a Bloom filter before it
    could only err towards keeping copies, so none is used."""
    x = F.lower(text) if lower else text
    x = T.collapse(x) if blanks else x
    return first_of(df, F.sha2(x, 256), pos)
