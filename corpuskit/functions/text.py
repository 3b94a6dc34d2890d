"""Native column functions on text. Character classes are written out so that Spark's regular
expressions, RE2 and Python agree on them."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks as Python's \s has them; \s itself is ASCII only in Java and RE2.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS, SOLID = f"[{BLANK}]", f"[^{BLANK}]"
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
DAY = DIGIT + "{1,2}"

USER_NAMES = tuple("client customer human questioner user".split())
ASSISTANT_NAMES = tuple("ai answerer assistant bot chatbot model system".split())

STOPWORDS = frozenset(
    """
    I a an as at be by do go he if in it me my no of on or so to up us we all and any but can day for get her him his
    how its new not now one our out say see she the two use way who you also back come even from give good have http
    into just know like look make most only over some take than that them then they this time want well what when will
    with work year your about after could first other their there these think which would people because
    """.split()
)


def literal(replacement: str) -> str:
    """A replacement that is taken as it stands."""
    return re.sub(r"([\\$])", r"\\\1", replacement)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+\\z", "")


def collapse(c: Column) -> Column:
    """Runs of blanks as one space, none at either end."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def normal_role(c: Column) -> Column:
    r = F.lower(strip(c))
    return (
        F.when(r.isin(*USER_NAMES) | (r == ""), "User")
        .when(r.isin(*ASSISTANT_NAMES), "Assistant")
        .otherwise(F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30)))
    )


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD}+)"), F.lit(1))


def replace_urls(c: Column, by: str = "[URL]") -> Column:
    return F.regexp_replace(c, rf"https?://{SOLID}+|www\.{SOLID}+", literal(by))


def replace_emails(c: Column, by: str = "[EMAIL]") -> Column:
    # A run of solid characters that has no match from its start has none at all. Most texts have no "@", and looking
    # for that is much faster; the text is bound, as it may be the result of other replacements.
    found = lambda x: F.regexp_replace(x, rf"(?<!{SOLID}){SOLID}+@{SOLID}+\.{SOLID}+", literal(by))
    return bind(c, lambda x: F.when(F.contains(x, F.lit("@")), found(x)).otherwise(x))


def replace_numbers(c: Column, by: str = "[NUMBER]") -> Column:
    return F.regexp_replace(c, rf"{DIGIT}+(?:\.{DIGIT}+)?", literal(by))


def strip_punctuation(c: Column) -> Column:
    return F.translate(c, string.punctuation, "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]*>", "")


def by_line(c: Column, f) -> Column:
    return F.array_join(F.transform(F.split(c, "\n", -1), f), "\n")


def _range(month: str, a: str, b: str, date_format: str) -> list[str]:
    sep = {"MM/DD": "/", "MM-DD": "-"}.get(date_format)
    return [month, sep, a, " to ", month, sep, b] if sep else ["from ", month, "/", a, " to ", month, "/", b]


def normalize_dates(c: Column, date_format: str = "MM/DD") -> Column:
    """Ranges of days spelled out: 2/3~28 as "2/3 to 2/28"; a bare 11~28 between commas takes the month
    of the line's first M/. Lines without a month stay."""
    full = "".join(_range("$1", "$2", "$3", date_format))

    def line(x: Column) -> Column:
        month = F.regexp_extract(x, rf"({DAY})/", 1)
        y = F.regexp_replace(x, rf"({DAY})/({DAY})~({DAY})", full)
        y = F.regexp_replace(y, rf"({DAY})/({DAY})[-~]({DAY})(?!/|-)", full)
        bare = F.concat(F.lit("$1"), *[month if p == "M" else F.lit(p) for p in _range("M", "$2", "$3", date_format)])
        y = F.regexp_replace(y, F.lit(rf"(^|[、，,]){WS}*({DAY})~({DAY}){WS}*(?=\z|[、，,])"), bare)
        return F.when(month == "", x).otherwise(y)

    return by_line(c, line)


#: In the order in which they are replaced.
_SHORT_DATES = (rf"{DAY}/{DAY}~{DAY}", rf"{DAY}/{DAY}[-~]{DAY}(?!/|-)", f"{DAY}/{DAY}", f"{DAY}-{DAY}", f"{DAY}~{DAY}")
_LONG_DATES = (rf"20{DIGIT}{{2}}/{DAY}/{DAY}", rf"20{DIGIT}{{2}}-{DAY}-{DAY}")


def replace_dates(c: Column, by: str = "[DATE]", compat: str = "intended") -> Column:
    """Dates replaced by ``by``. ``intended``: years first, and bare days listed after a date are dates too.
    ``reference``: short forms first, so that 2023/12/25 keeps its century."""
    to = literal(by)

    def line(x: Column) -> Column:
        if compat == "reference":
            for p in (*_SHORT_DATES, *_LONG_DATES):
                x = F.regexp_replace(x, p, to)
            klass = by if re.fullmatch(r"\[[^\]\\]+\]", by) else re.escape(by)
            # The placeholder stands in the pattern as it is, thus [DATE] is any of its letters.
            y = F.regexp_replace(x, rf"{klass}[、,，] ?{DAY}[、,，]", literal(f"{by}、{by}、"))
            y = F.regexp_replace(y, rf"{klass}[、,，] ?{DAY}", literal(f"{by}、{by}"))
            return F.when(F.contains(x, F.lit(by)), y).otherwise(x)
        for p in (*_LONG_DATES, *_SHORT_DATES):
            x = F.regexp_replace(x, p, to)
        # Days in a list that a date begins; each match starts where the last one ended.
        return F.regexp_replace(x, rf"(?:(?<={re.escape(by)})|\G(?<!^))([、,，] ?){DAY}(?!{DIGIT})", "$1" + to)

    return by_line(c, line)


def special_ratio(c: Column) -> Column:
    """Share of characters that are neither letters or digits nor blanks."""
    n = F.length(c)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(c, rf"[\p{{L}}\p{{N}}{BLANK}]+", "")) / n)


def bind(x: Column, f) -> Column:
    """f of a value that is worked out once: an outer column inside a lambda is worked out for every element."""
    return F.element_at(F.transform(F.array(x), f), 1)


def char_ngrams(c: Column, n: int) -> Column:
    """All runs of n characters, with repeats; none in shorter text. Linear in the text: substring would
    count its characters from the start each time."""
    none = F.array().cast("array<string>")
    grams = lambda chars: F.when(
        F.size(chars) >= n, F.transform(F.sequence(F.lit(1), F.size(chars) - (n - 1)), lambda i: F.array_join(F.slice(chars, i, F.lit(n)), ""))
    ).otherwise(none)
    return bind(F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1)), grams)


def dedup_text(c: Column) -> Column:
    """Lower case with blanks collapsed, on which duplicates are told."""
    return collapse(F.lower(c))
