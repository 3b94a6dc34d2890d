"""Cleaning filters on conversations, in the order in which they run."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import messages as M


def valid(df: DataFrame) -> DataFrame:
    return df.where(M.is_valid())


def length_between(df: DataFrame, max_length: int = 32768, min_length: int | None = None) -> DataFrame:
    """Conversations whose messages have at most ``max_length`` characters in all; a lower bound is optional."""
    n = M.total_length()
    return df.where((n <= max_length) if min_length is None else n.between(min_length, max_length))


def stopword_ratio(words: Column, stopwords=T.STOPWORDS) -> Column:
    stop = F.filter(words, lambda w: w.isin(*sorted(stopwords)))
    return F.when(F.size(words) > 0, F.size(stop) / F.size(words)).otherwise(F.lit(1.0))


def few_stopwords(df: DataFrame, max_ratio: float = 0.5, min_words: int = 20, custom=(), stopwords_of=T.STOPWORDS) -> DataFrame:
    words = M.all_words()
    return df.where((F.size(words) < min_words) | (stopword_ratio(words, frozenset(stopwords_of) | set(custom)) <= max_ratio))


def in_languages(df: DataFrame, languages: list[str] | None = None, column: str = "lang") -> DataFrame:
    """Passes all rows unless languages are given."""
    return df.where(F.col(column).isin(*languages)) if languages else df


Filter = Callable[[DataFrame], DataFrame]
#: The places for rules on addresses and on paragraphs. Both pass all rows until a rule is registered.
FILTERS: dict[str, Filter] = {"url": lambda df: df, "paragraph": lambda df: df}


def register_filter(name: str, rule: Filter) -> None:
    """Set the rule that stands for ``url`` or ``paragraph``, or add one of another name."""
    FILTERS[name] = rule


def load_stopwords(path: str) -> frozenset[str]:
    """Words of a file, one a line, in lower case; the usual ones if it can't be read."""
    try:
        lines = Path(path).read_text(encoding="utf-8").splitlines()
    except (OSError, UnicodeDecodeError):
        return T.STOPWORDS
    return frozenset(w for w in (x.strip().lower() for x in lines) if w)


def digest(c: Column | None = None, algorithm: str = "md5") -> Column:
    """Digest of "role:content" of all messages, joined by "||"; a null prints as None."""
    part = lambda m, f: F.coalesce(m[f], F.lit("None"))
    text = F.array_join(F.transform(M._conv(c), lambda m: F.concat(part(m, "role"), F.lit(":"), part(m, "content"))), "||")
    return F.sha2(text, 256) if algorithm == "sha256" else F.md5(text)


def first_of(df: DataFrame, key: Column, order: str = "pos") -> DataFrame:
    """The first row by ``order`` of each key, with all its columns.

    Only key and position are compared; equal positions are told apart by nothing, so positions should differ.
    Ranks are limited within partitions before rows are moved, so that copies of a key aren't gathered."""
    at = Window.partitionBy("__key").orderBy(order)
    return df.withColumn("__key", key).withColumn("__at", F.row_number().over(at)).where("__at = 1").drop("__key", "__at")


def exact_dedup(df: DataFrame, algorithm: str = "md5") -> DataFrame:
    return first_of(df, digest(algorithm=algorithm))


def clean(df: DataFrame, max_length: int = 32768, stopwords: bool = True, dedup: bool = True, algorithm: str = "md5", min_length: int | None = None, languages: list[str] | None = None, language: str = "lang", filters: Iterable[str] = ("url", "paragraph"), seen: Callable[[DataFrame, str], DataFrame] = lambda df, name: df, **stop) -> DataFrame:
    """All cleaning filters: validity, length, stopwords, languages, registered rules, then exact duplicates.

    ``languages``: those that stay, by column ``language`` (None: all). ``filters``: rules that are on. ``seen`` is
    called with what each step leaves and the step's name."""
    out = seen(df.transform(valid).transform(length_between, max_length, min_length), "length")
    if stopwords:
        out = seen(out.transform(few_stopwords, **stop), "stopwords")
    if languages:
        out = seen(out.transform(in_languages, languages, language), "language")
    for name in filters:
        out = seen(out.transform(FILTERS[name]), name)
    return seen(out.transform(exact_dedup, algorithm), "exact_dedup") if dedup else out
