"""Message exports of a social platform: inbox/<thread>/message_N.json."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.unicode import repair
from ..operators.messages import MESSAGE

THREAD = "thread_path string, participants array<struct<name:string>>, messages array<struct<sender_name:string, content:string, timestamp_ms:bigint>>"


def repaired_json(raw: bytes) -> str | None:
    """The file as clean JSON with every string's encoding put right; null if it can't be read."""
    text = re.sub("[\x00-\x1f\x7f]", "", raw.decode("utf-8", "ignore"))
    for attempt in (text, re.sub(r'\\(?![/bfnrtu"\\])', r"\\\\", re.sub("[\x80-\x9f]", "", text))):
        try:
            return json.dumps(_walk(json.loads(attempt)), ensure_ascii=False)
        except ValueError:
            continue
    return None


def _walk(x):
    if isinstance(x, str):
        return repair(x)
    if isinstance(x, list):
        return [_walk(y) for y in x]
    return {k: _walk(v) for k, v in x.items()} if isinstance(x, dict) else x


@F.pandas_udf(StringType())
def _repaired(s: pd.Series) -> pd.Series:
    return s.map(repaired_json)


@F.pandas_udf(StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    def one(t: str) -> str:
        t = re.sub(r"\\u([0-9A-Fa-f]{4})", lambda m: chr(int(m[1], 16)), t)
        return re.sub(r"&#([0-9]+);", lambda m: chr(int(m[1])) if int(m[1]) < 0x110000 else m[0], t)

    return s.map(one, na_action="ignore")


def read_threads(spark: SparkSession, inbox: str) -> DataFrame:
    """(source_file, source_folder, thread_path, participants, messages) of every readable file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "message_*.json").load(f"{inbox.rstrip('/')}/*/")
    parsed = files.select(F.col("path").alias("source_file"), F.from_json(_repaired("content"), THREAD).alias("t"))
    folder = F.element_at(F.split("source_file", "/"), -2)
    return parsed.where("t is not null").select("source_file", folder.alias("source_folder"), "t.*")


def most_frequent(threads: DataFrame) -> str | None:
    """The name that takes part in most threads, the first by name among equals: in an export, most likely its owner's."""
    names = threads.select(F.explode(F.array_distinct(F.transform("participants", lambda p: p["name"]))).alias("who")).where("who is not null")
    first = names.groupBy("who").count().orderBy(F.desc("count"), "who").first()
    return first.who if first else None


def account_owner(participants: Column, user_name: str | None, usual: str | None = None) -> Column:
    """Whose export it is: the configured name, a name that contains it or is contained in it, the ``usual`` name if
    there is one, the second of two, otherwise the configured name or the first."""
    n = F.size(participants)
    rest = F.lit(usual) if usual else F.when(n == 2, F.element_at(participants, 2)).when(n > 0, F.lit(user_name) if user_name else F.element_at(participants, 1)).otherwise("Unknown")
    if not user_name:
        return rest
    me = F.lit(user_name)
    alike = F.filter(participants, lambda p: F.contains(p, me) | F.contains(me, p))
    return F.when(F.array_contains(participants, me), me).when(F.size(alike) > 0, F.element_at(alike, 1)).otherwise(rest)


def transform_threads(threads: DataFrame, user_name: str | None, platform: str = "social", by_frequency: bool = False) -> DataFrame:
    """``by_frequency``: where the configured name doesn't help, the owner is who takes part in most threads.

    Conversations: messages by time (as they stood among equals), without empty ones; whoever has the
    configured name is the Assistant. Times are those of the first and last message, also empty ones."""
    stamped = F.transform("messages", lambda m, i: F.struct(F.coalesce(m["timestamp_ms"], F.lit(0)).alias("ts"), i.alias("i"), F.coalesce(m["sender_name"], F.lit("Unknown")).alias("who"), m["content"].alias("content")))
    rows = threads.where("size(messages) > 0").withColumn("m", F.array_sort(stamped)).withColumn("names", F.transform("participants", lambda p: p["name"]))
    role = lambda m: F.when(m["who"] == F.lit(user_name), "Assistant").otherwise("User")
    said = F.filter("m", lambda m: F.coalesce(m["content"], F.lit("")) != "")
    out = rows.select(
        "source_file", "source_folder", F.lit(platform).alias("platform"), F.col("thread_path").alias("conversation_id"), F.col("names").alias("participants"), account_owner(F.col("names"), user_name, most_frequent(threads) if by_frequency else None).alias("account_owner"),
        F.timestamp_millis(F.element_at("m", 1)["ts"]).alias("created_at"), F.timestamp_millis(F.element_at("m", -1)["ts"]).alias("last_message_at"),
        F.transform(said, lambda m: F.struct(role(m).alias("role"), m["content"].alias("content"), F.lit(None).cast("boolean").alias("do_train"))).cast(f"array<{MESSAGE}>").alias("conversation"),
    )
    return out


def unescape(c: Column) -> Column:
    """\\uXXXX and &#N; as the characters they stand for."""
    return _unescaped(c)


def summary(conversations: DataFrame) -> DataFrame:
    each = conversations.select(F.size("conversation").alias("n"), F.explode_outer("participants").alias("who"), "source_file")
    return conversations.agg(F.count("*").alias("conversations"), F.sum(F.size("conversation")).alias("messages")).crossJoin(each.agg(F.countDistinct("who").alias("participants")))
