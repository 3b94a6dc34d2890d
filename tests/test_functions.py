"""Text functions on small cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.functions import unicode as U


def run(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


def test_roles(spark):
    assert run(spark, T.normal_role, " Human ", "BOT", "system", "agent", "", None) == ["User", "Assistant", "Assistant", "Agent", "User", None]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2/3~28", "2/3 to 2/28"),
        ("2/2~9、11~28", "2/2 to 2/9、2/11 to 2/28"),
        ("x 3/4-5, 6~7 ,8~9", "x 3/4 to 3/5,3/6 to 3/7,3/8 to 3/9"),
        ("2023/12/25~26", "2023/12/25 to 12/26"),
        ("no 1~2", "no 1~2"),
        ("2/3~28\nno 1~2", "2/3 to 2/28\nno 1~2"),
        ("", ""),
    ],
)
def test_normalize_dates(spark, text, want):
    assert run(spark, T.normalize_dates, text) == [want]


def test_date_formats(spark):
    assert run(spark, lambda c: T.normalize_dates(c, "MM-DD"), "2/3~28") == ["2-3 to 2-28"]
    assert run(spark, lambda c: T.normalize_dates(c, "verbose"), "2/3~28") == ["from 2/3 to 2/28"]


def test_replace_dates(spark):
    assert run(spark, T.replace_dates, "2023/12/25", "市:3/8、11、16、13、3/19~22", "9、10") == ["[DATE]", "市:[DATE]、[DATE]、[DATE]、[DATE]、[DATE]", "9、10"]
    reference = lambda c: T.replace_dates(c, compat="reference")
    assert run(spark, reference, "2023/12/25", "市:3/8、11、16、13、3/19~22") == ["20[DATE]/25", "市:[DATE]、11、16、13、[DATE]"]


def test_replacements(spark):
    assert run(spark, T.replace_urls, "see https://a.b/c now", "www.x.y　z") == ["see [URL] now", "[URL]　z"]
    assert run(spark, lambda c: T.replace_urls(c, r"$1\x"), "see https://a.b/c now") == [r"see $1\x now"]
    assert run(spark, T.replace_emails, "to a@b.c now") == ["to [EMAIL] now"]
    assert run(spark, T.replace_numbers, "v 1.25 and ３") == ["v [NUMBER] and [NUMBER]"]
    assert run(spark, T.strip_punctuation, "see [URL], ok!") == ["see URL ok"]
    assert run(spark, T.collapse, " a\t\n　b ", "\x1c") == ["a b", ""]


def test_html(spark):
    assert run(spark, U.clean_html, "a&lt;b&gt;c <i>d</i>", None, "<br>x") == ["ac d", None, "x"]


def test_unicode(spark):
    assert run(spark, U.fix_mojibake, "cafÃ©", "café", None) == ["café", "café", None]
    assert run(spark, U.normalize_unicode, "“ﬁx”\r\nＡ\x07 é") == ['"fix"\nA é']
    assert run(spark, U.nfc, "é") == ["é"]


def test_ngrams(spark):
    assert run(spark, lambda c: T.char_ngrams(c, 3), "abcd", "ab", "", "a🎉b", None) == [["abc", "bcd"], [], [], ["a🎉b"], []]
    assert run(spark, T.special_ratio, "a!b?", "") == [0.5, 0.0]


def test_emails_are_looked_for_by_their_sign(spark):
    texts = ["a b@c.de f", "@", "x@y", "x@y.", "a@b@c.d, e", "none here", "", None, "日本@例え.テスト\u3000a@b.c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = [r[0] for r in df.orderBy("id").select(T.replace_emails(F.col("t"))).collect()]
    assert got == ["a [EMAIL] f", "@", "x@y", "x@y.", "[EMAIL] e", "none here", "", None, "[EMAIL]\u3000[EMAIL]"]
    assert "contains" in df.select(T.replace_emails(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().lower()
