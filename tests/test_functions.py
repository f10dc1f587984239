"""Behaviour of single functions on literal inputs."""

import pytest
from pyspark.sql import functions as F

from lodestream.functions import ids, text, urls
from lodestream.operators import facts, metrics
from lodestream.sources import robots


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("", ""), ("https://u:p@a.example.com/", ""), ("https://a.example.com/path#section", "https://a.example.com/path"), ("http://a.example.com/", ""), ("https://127.0.0.1/", ""),
        ("https://10.0.0.1/", ""), ("https://192.168.1.1/x", ""), ("https://[::1]/", ""), ("https://localhost/", ""), ("https://a.example.com:8080/", ""), ("https://A.example.com", "https://a.example.com/"),
    ],
)
def test_public_urls(spark, url, want):
    assert one(spark, urls.normalize_public_url(F.col("u")), u=url) == want


def test_http_is_opt_in(spark):
    assert one(spark, urls.normalize_public_url(F.col("u"), True), u="http://a.example.com/x?y#z") == "http://a.example.com/x?y"


@pytest.mark.parametrize(("host", "want"), [("blog.x.com", "x.com"), ("news.y.co.uk", "y.co.uk"), ("x.com", "x.com"), ("a.b.com.cn", "b.com.cn")])
def test_etld1(spark, host, want):
    assert one(spark, urls.etld1(F.col("h")), h=host) == want


def test_the_two_suffix_lists_differ(spark):
    assert one(spark, urls.registrable_domain(F.col("h")), h="a.b.co.kr") == "b.co.kr"
    assert one(spark, urls.etld1(F.col("h")), h="a.b.co.kr") == "co.kr"


@pytest.mark.parametrize(("words", "n"), [("五个汉字吧", 5), ("two 汉字", 3), ("안녕하세요", 5), ("   ", 0), ("w " * 26, 26)])
def test_word_count(spark, words, n):
    assert one(spark, text.word_count(F.col("t")), t=words) == n


def test_markup_does_not_change_the_fingerprint(spark):
    a = one(spark, ids.fingerprint(F.col("t"), F.col("u")), t="**Big** <b>News</b>!", u="https://a.example.com/x/")
    assert a == one(spark, ids.fingerprint(F.col("t"), F.col("u")), t="big news", u="http://a.example.com/x?q=1") == "big news|a.example.com/x"


@pytest.mark.parametrize(("key", "forbidden", "metric"), [("userId", True, None), ("user_id", True, None), ("session_token", True, None), ("share_count", False, "shares"), ("likes", False, "reactions"), ("count", False, None)])
def test_metric_keys(spark, key, forbidden, metric):
    assert one(spark, metrics.forbidden_key(F.col("k")), k=key) is forbidden
    assert one(spark, metrics.metric_of(F.col("k")), k=key) == metric


def test_last_metric_wins(spark):
    df = spark.sql("select array(named_struct('key','like','value',1.0D), named_struct('key','userid','value',9.0D), named_struct('key','hearts','value',3.0D)) e")
    assert df.select(metrics.interaction(F.col("e")).alias("i")).first()["i"].asDict() == {"shares": None, "comments": None, "reactions": 3.0}


def test_eight_shared_words_are_verbatim(spark):
    body = "we saw that one two three four five six seven eight were there"
    assert one(spark, facts.overlaps(F.col("s"), F.col("b")), s="One two, three four five six seven EIGHT.", b=body)
    assert not one(spark, facts.overlaps(F.col("s"), F.col("b")), s="one two three four five six seven", b=body)
    assert not one(spark, facts.overlaps(F.col("s"), F.col("b")), s="one two three four five six seven eight", b="")


def test_split_title(spark):
    title, source = text.split_title(F.col("t"), F.col("l"))
    assert one(spark, title, t="A long story - The Paper", l="") == "A long story"
    assert one(spark, source, t="A long story - The Paper", l="") == "The Paper"
    assert one(spark, source, t="A long story - The Paper", l="Feed") == "Feed"
    assert one(spark, source, t="A story", l="") == "News source"


def test_truncation_cuts_at_a_word(spark):
    out = one(spark, text.truncate_hint(F.col("t")), t="word " * 100)
    assert out.endswith("word…") and len(out) <= 251


def test_entities_are_decoded_ampersand_first(spark):
    assert one(spark, text.html_text(F.col("t")), t="<p>a &amp;lt; b</p><script>x<y</script>") == "a < b"


def test_robots_lines():
    rules = robots.parse("User-agent: *\nDisallow: /a # x\nAllow: /a/b\n\nDisallow: /lost\nUser-agent: lodestream\nCrawl-delay: 3\nUser-agent: other\nDisallow: /")
    assert rules == [("disallow", "/a", None), ("allow", "/a/b", None), ("delay", "", 3.0)]


@pytest.mark.parametrize("value", ["__proto__", "x" * 10_000, "", "\x00\x01\x02", "🙂" * 300])
def test_hostile_titles(spark, value):
    assert one(spark, text.normalize_title(F.col("t")), t=value) == one(spark, text.normalize_title(F.col("t")), t=value)
    assert one(spark, text.truncate_hint(F.col("t")), t=value) is not None


def test_gram_words_of_plain_and_other_text(spark):
    import random

    from pyspark.sql import functions as F

    from lodestream.functions import text as T

    r = random.Random(3)
    signs = ["a", "B", "7", "_", ".", "-", " ", "\t", "\n", "\x0b", "\f", "\r", "\x00", "\x1f", "é", "İ", "K", "\xa0", "﻿", " ", "漢", "か", "안", "㐀", "豈", "😀"]
    rows = [("".join(r.choices(signs[:14] if n % 3 else signs, k=r.randrange(40))),) for n in range(600)] + [("",), (" ",), (None,), ("\t a",), ("é",)]
    before = T.tokens(F.regexp_replace(F.lower(F.col("t")), rf"[^a-z0-9_\t\n\x0B\f\r \x{{a0}}\x{{feff}}{T.CJK}]", ""))
    got = spark.createDataFrame(rows, "t string").select("t", T.gram_words(F.col("t")).alias("got"), before.alias("want")).collect()
    assert all(x["got"] == x["want"] for x in got) and any(x["got"] for x in got)
    # ASCII text isn't cut by the expression with the CJK ranges
    assert "split" in spark.range(1).select(T.gram_words(F.lit("x").cast("string"))).columns[0].lower()
