"""The chain of text functions that a configuration asks for, on messages and headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import unicode as U


def native_format(conf: dict, c: Column) -> Column:
    """Everything but what needs Python, in order; replacing dates goes before normalising them."""
    if conf["replace_dates"]:
        c = T.replace_dates(c, conf["date_replacement"])
    elif conf["normalize_dates"]:
        c = T.normalize_dates(c, conf["date_format"])
    if conf["replace_urls"]:
        c = T.replace_urls(c, conf["url_replacement"])
    if conf["replace_emails"]:
        c = T.replace_emails(c, conf["email_replacement"])
    if conf["replace_numbers"] and not (conf["replace_dates"] or conf["normalize_dates"]):
        c = T.replace_numbers(c, conf["number_replacement"])
    if conf["remove_punctuation"]:
        c = T.strip_punctuation(c)
    if conf["normalize_whitespace"]:
        c = T.collapse(c)
    return F.lower(c) if conf["lowercase"] else c


def format_conversations(df: DataFrame, conf: dict) -> DataFrame:
    """Formats each message's content and the title, summary and description.

    Arrow functions don't run inside higher-order functions: contents pass through them as one array."""
    heads = [c for c in ("title", "summary", "description") if c in df.columns]
    out = df
    if conf["fix_unicode"] or conf["clean_html"]:
        flags = (conf["fix_unicode"], conf["clean_html"])
        fixed = U.fix_all(F.transform("conversation", lambda m: m["content"]), *flags)
        out = out.withColumn("__fixed", fixed)
        out = out.withColumn("conversation", F.transform("conversation", lambda m, i: m.withField("content", F.get("__fixed", i)))).drop("__fixed")
        for h in heads:
            out = out.withColumn(h, F.get(U.fix_all(F.array(h), *flags), F.lit(0)))
    out = out.withColumn("conversation", F.transform("conversation", lambda m: m.withField("content", native_format(conf, m["content"]))))
    for h in heads:
        out = out.withColumn(h, native_format(conf, F.col(h)))
    return out
