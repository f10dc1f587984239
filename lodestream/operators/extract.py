"""Article documents and the choice of a body for each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text, urls
from .dedup import first_wins

#: Larger pages are refused.
PAGE_BYTES = 3_000_000
SNIPPET_CHARS = 500


def bounded(c: Column, limit: int) -> Column:
    """The body, null if its UTF-8 form is longer than the limit."""
    return F.when(F.octet_length(c) <= limit, c)


def canonical(url: Column) -> Column:
    """Origin and path, the query dropped: how a failed document is named."""
    return F.concat(F.lower(urls.part(url, 1)), F.lit("://"), urls.host(url), F.when(urls.part(url, 3) == "", F.lit("/")).otherwise(urls.part(url, 3)))


def documents(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Source documents of fetched pages (url, html; allowed by robots, null: yes; content_type, null: HTML): id, url, domain, extraction, access_policy, word_count, lang, content_hash, body.

    ``keep``: columns of ``pages`` to carry along. The body is private: drop it before publishing. An unsafe URL, another content type, a refusal by robots,
    a missing page or one too large failed. A paywalled page gives its first 500 characters, and an empty one counts as a word.
    """
    column = lambda name, kind: F.col(name) if name in pages.columns else F.lit(None).cast(kind)
    safe = urls.normalize_public_url(F.col("url"))
    kind = F.lower(F.coalesce(column("content_type", "string"), F.lit("text/html")))
    rows = pages.withColumns({"_safe": safe, "_html": bounded(F.col("html"), PAGE_BYTES), "_allowed": F.coalesce(column("allowed", "boolean"), F.lit(True))})
    rows = rows.withColumn("_domain", urls.source_domain(F.when(F.col("_safe") == "", F.col("url")).otherwise(F.col("_safe")))).withColumn("_text", text.html_text(F.col("_html")))
    unsafe = (F.col("_safe") == "") | ~(F.contains(kind, F.lit("text/html")) | F.contains(kind, F.lit("application/xhtml")))
    policy = (
        F.when(F.col("_safe") == "", "tos-restricted").when(~F.col("_allowed"), "robots-disallowed").when(F.col("_html").isNull(), "allowed").when(unsafe, "tos-restricted")
        .when(F.coalesce(text.paywalled(F.col("_html"), F.col("_domain")), F.lit(False)), "paywalled").otherwise("allowed")
    )
    rows = rows.withColumn("_policy", policy).withColumn("_failed", F.col("_html").isNull() | F.col("_policy").isin("robots-disallowed", "tos-restricted"))
    closed = F.col("_policy") == "paywalled"
    rows = rows.withColumn("_body", F.when(closed, F.substring("_text", 1, SNIPPET_CHARS)).otherwise(text.main_body(F.col("_text"))))
    words = F.when(closed, F.size(F.split("_body", f"{text.WS}+"))).otherwise(text.space_words(F.col("_body"))).cast("long")
    address = F.when(F.col("_failed"), canonical(F.when(F.col("_safe") == "", F.col("url")).otherwise(F.col("_safe")))).otherwise(F.col("_safe"))
    made = {
        "id": ids.doc_id(address), "url": address, "domain": F.col("_domain"), "extraction": F.when(F.col("_failed"), "failed").when(closed | (words <= 50), "snippet").otherwise("full"),
        "access_policy": F.col("_policy"), "word_count": F.when(~F.col("_failed"), words), "lang": F.when(~F.col("_failed"), text.page_lang(F.col("_html"))),
        "content_hash": ids.content_hash(F.when(F.col("_failed"), F.lit("")).otherwise(F.col("_body"))), "body": F.when(~F.col("_failed"), F.col("_body")),
    }
    return rows.select(*[F.col(c) for c in keep or [] if c not in made], *[v.alias(k) for k, v in made.items()])


def chosen_bodies(items: DataFrame, stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Items (id, url, source_domain, summary_hint, feed_body) with body and body_origin.

    In this order: the store's document unless it failed (stored: url, extraction, body), the feed's body of 100 characters or more (the first of the URL), a
    search feed's hint of 50 or more, the fetched document (fetched: url, body). Three left joins on the URL, no fetch for what is known.
    """
    s = stored.filter("extraction <> 'failed'").select("url", F.col("body").alias("s_body"))
    feed = first_wins(items.filter("feed_body is not null").select("url", F.col("feed_body").alias("f_body"), "id"), ["url"], ["id"]).drop("id")
    got = fetched.select("url", F.col("body").alias("g_body"))
    rows = items.join(s, "url", "left").join(feed, "url", "left").join(got, "url", "left")
    long_feed = F.when(F.length("f_body") >= 100, F.col("f_body"))
    hint = F.when((F.col("source_domain") == "news.google.com") & (F.length("summary_hint") >= 50), F.col("summary_hint"))
    origin = F.when(F.col("s_body").isNotNull(), "store").when(long_feed.isNotNull(), "feed").when(hint.isNotNull(), "hint").when(F.col("g_body").isNotNull(), "fetch").otherwise("none")
    return rows.select(*items.columns, F.coalesce("s_body", long_feed, hint, "g_body").alias("body"), origin.alias("body_origin"))


def eligible(docs: DataFrame) -> DataFrame:
    """Documents that may be mined: not failed, access allowed, 100 characters or more."""
    return docs.filter((F.col("extraction") != "failed") & (F.col("access_policy") == "allowed") & (F.length("body") >= 100))


def without_body(docs: DataFrame) -> DataFrame:
    """The public schema has no text of the source."""
    return docs.drop("body", "feed_body", "html")
