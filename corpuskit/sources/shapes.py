"""Items of unknown shape to conversations; the first shape that fits wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.messages import MESSAGE


def part(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def has(v: Column, name: str) -> Column:
    return part(v, name).isNotNull()


def string(v: Column, name: str) -> Column:
    """The value if it is a string; numbers aren't turned into text."""
    return F.when(F.schema_of_variant(part(v, name)) == "STRING", F.try_variant_get(v, f"$.{name}", "string"))


def message(role: Column, content: Column, do_train: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"), do_train.cast("boolean").alias("do_train")).cast(MESSAGE)


def elements(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "array<variant>")


def _role_message(m: Column) -> Column:
    return message(string(m, "role"), string(m, "content"), F.coalesce(F.try_variant_get(m, "$.do_train", "boolean"), F.lit(True)))


def _named_message(m: Column, who: str) -> Column:
    return message(T.normal_role(string(m, who)), string(m, "text"), F.lit(True))


def _some(messages: Column) -> Column:
    return F.when(F.size(messages) > 0, messages)


def from_standard(v: Column) -> Column:
    rows = F.transform(elements(v, "conversation"), _role_message)
    return F.when((F.size(rows) > 0) & F.forall(rows, lambda m: m["role"].isNotNull() & m["content"].isNotNull()), rows)


def from_messages(v: Column) -> Column:
    one = lambda m: F.when(has(m, "role") & has(m, "content"), _role_message(m)).when(has(m, "sender") & has(m, "text"), _named_message(m, "sender"))
    return _some(F.filter(F.transform(elements(v, "messages"), one), lambda m: m.isNotNull()))


def from_dialog(v: Column) -> Column:
    """Bare strings alternate between User and Assistant by the messages before them."""

    def step(done: Column, m: Column) -> Column:
        even = F.size(done) % 2 == 0
        bare = message(F.when(even, "User").otherwise("Assistant"), F.try_variant_get(m, "$", "string"), ~even)
        one = (
            F.when(F.schema_of_variant(m) == "STRING", bare)
            .when(has(m, "speaker") & has(m, "text"), _named_message(m, "speaker"))
            .when(has(m, "role") & has(m, "content"), _role_message(m))
        )
        return F.when(one.isNotNull(), F.array_append(done, one)).otherwise(done)

    return _some(F.aggregate(elements(v, "dialog"), F.array().cast(f"array<{MESSAGE}>"), step))


def _pair(q: Column, a: Column) -> Column:
    both = F.array(message(F.lit("User"), q, F.lit(False)), message(F.lit("Assistant"), a, F.lit(True)))
    return F.when(q.isNotNull() & a.isNotNull(), both)


def _first(v: Column, names: str, filled: bool) -> Column:
    got = [string(v, n) for n in names.split()]
    return F.coalesce(*[F.when(x != "", x) if filled else x for x in got])


def from_question(v: Column) -> Column:
    return _pair(_first(v, "text question query input", True), _first(v, "response answer output completion", True))


def best_effort(v: Column) -> Column:
    return _pair(_first(v, "query question input prompt", False), _first(v, "response answer output completion assistant", False))


def conversation(v: Column) -> Column:
    """The messages of an item, null if it has no known shape."""
    return (
        F.when(from_standard(v).isNotNull(), from_standard(v))
        .when(has(v, "messages"), from_messages(v))
        .when(has(v, "dialog"), from_dialog(v))
        .when(has(v, "text") & has(v, "user"), from_question(v))
        .otherwise(best_effort(v))
    )


def standardise(items: DataFrame) -> DataFrame:
    """Conversations of (source_file, ordinal, item); items without a known shape are left out."""
    out = items.select("source_file", "ordinal", "item", conversation(F.col("item")).alias("conversation")).where("conversation is not null")
    keep = [string(F.col("item"), k).alias(k) for k in ("conversation_id", "platform", "title", "summary", "description")]
    return out.select(F.struct("source_file", "ordinal").alias("pos"), *keep, part(F.col("item"), "metadata").alias("metadata"), "conversation")
