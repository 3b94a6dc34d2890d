"""Operators on conversations held as arrays of messages; none of them shuffles.

A conversation is ARRAY<STRUCT<role STRING, content STRING, do_train BOOLEAN>>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

MESSAGE = "struct<role:string,content:string,do_train:boolean>"


def from_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text", normal_roles: bool = True) -> DataFrame:
    """(conversation_id, pos, conversation) from one row a message; the only shuffle of this module.

    pos orders conversations as the ids do."""
    r = T.normal_role(F.col(role)) if normal_roles else F.col(role)
    each = F.struct(F.col(turn).alias("turn"), F.col(role).alias("was"), r.alias("role"), F.col(content).alias("content"))
    rows = turns.groupBy(F.col(conv).alias("conversation_id")).agg(F.array_sort(F.collect_list(each)).alias("m"))
    message = lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), (x["role"] == "Assistant").alias("do_train"))
    return rows.select("conversation_id", F.col("conversation_id").alias("pos"), F.transform("m", message).alias("conversation"))


def _conv(c: Column | None) -> Column:
    return F.col("conversation") if c is None else c


def is_valid(c: Column | None = None) -> Column:
    c = _conv(c)
    return F.coalesce((F.size(c) > 0) & F.forall(c, lambda m: m["role"].isNotNull() & m["content"].isNotNull()), F.lit(False))


def total_length(c: Column | None = None) -> Column:
    return F.aggregate(_conv(c), F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))


def all_words(c: Column | None = None) -> Column:
    return F.flatten(F.transform(_conv(c), lambda m: T.words(m["content"])))


def is_blocked(content: Column, filter_words: list[str] | None) -> Column:
    out = F.lit(False)
    for w in filter_words or []:
        out = out | F.contains(content, F.lit(w))
    return out


def drop_blocked(df: DataFrame, filter_words: list[str] | None) -> DataFrame:
    """Without empty messages and those that contain a listed word; without conversations that this empties."""
    keep = F.filter("conversation", lambda m: m["content"].isNotNull() & (m["content"] != "") & ~is_blocked(m["content"], filter_words))
    return df.withColumn("conversation", keep).where(F.size("conversation") > 0)


def transfer_roles(df: DataFrame, assistant_to_user: list[str] | None = None, user_to_assistant: list[str] | None = None, compat: str = "intended") -> DataFrame:
    """Turns over the role of messages that contain a listed sentence.

    ``intended``: only those messages. ``reference``: a hit sets a role that later User messages
    inherit; any other message sets it to its own role; a leading User message gets none."""
    if not (assistant_to_user or user_to_assistant):
        return df
    hit = lambda m: (
        F.when((m["role"] == "Assistant") & is_blocked(m["content"], assistant_to_user), "User").when((m["role"] == "User") & is_blocked(m["content"], user_to_assistant), "Assistant")
    )
    if compat == "intended":
        turned = F.transform("conversation", lambda m: m.withField("role", F.coalesce(hit(m), m["role"])))
        return df.withColumn("conversation", turned)

    def step(s: Column, m: Column) -> Column:
        state = F.coalesce(hit(m), F.when(m["role"] == "User", s["state"]).otherwise(m["role"]))
        return F.struct(state.alias("state"), F.array_append(s["done"], m.withField("role", state)).alias("done"))

    start = F.struct(F.lit(None).cast("string").alias("state"), F.array().cast(f"array<{MESSAGE}>").alias("done"))
    same = F.transform("conversation", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["do_train"].alias("do_train")))
    return df.withColumn("conversation", F.aggregate(same, start, step, lambda s: s["done"]))


def qa_pairs(df: DataFrame) -> DataFrame:
    """(conversation_id, n, question, answer): each User message with the Assistant messages up to the next.

    Answers are joined as the messages with a line break each and a space between. Blank answers
    and pairs without question or answer are left out; n counts the pairs of a conversation from 0."""
    c = F.col("conversation")
    asked = F.filter(F.sequence(F.lit(1), F.size(c)), lambda i: F.element_at(c, i)["role"] == "User")

    def pair(users: Column, u: Column, k: Column) -> Column:
        after = F.coalesce(F.get(users, k + 1), F.size(c) + 1)
        said = F.filter(F.slice(c, u + 1, after - u - 1), lambda m: (m["role"] == "Assistant") & (T.strip(m["content"]) != ""))
        return F.struct(F.element_at(c, u)["content"].alias("question"), F.transform(said, lambda m: F.concat(m["content"], F.lit("\n"))).alias("answers"))

    pairs = F.when(F.size(c) > 0, T.bind(asked, lambda users: F.transform(users, lambda u, k: pair(users, u, k))))
    pairs = F.filter(pairs, lambda p: (F.coalesce(p["question"], F.lit("")) != "") & (F.size(p["answers"]) > 0))
    rows = df.select("conversation_id", F.posexplode(pairs).alias("n", "p"))
    return rows.select("conversation_id", F.col("n").cast("long").alias("n"), F.col("p.question").alias("question"), F.array_join("p.answers", " ").alias("answer"))
