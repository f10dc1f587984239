"""Landed RSS 2.0 and Atom feeds to entries and raw items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.text import split_title, strip_markup, truncate_hint
from ..functions.urls import normalize_public_url, source_domain

RSS = "channel struct<item: array<struct<title: string, link: string, pubDate: string, source: struct<_VALUE: string, _url: string>, description: string, `content:encoded`: string>>>"
ATOM = (
    "entry array<struct<title: string, link: array<struct<_href: string, _rel: string>>, published: string, updated: string, summary: string, content: string,"
    " author: struct<name: string>>>"
)
#: Larger bodies are refused.
FEED_BYTES = 1_500_000


def entries(feeds: DataFrame) -> DataFrame:
    """One row an entry (source, rank, title, url, pub_date, source_label, source_url, description, raw_content); feeds: source, xml.

    The rank is the place in the feed before any filter. A body that is too large or no feed has none.
    """
    small = feeds.filter(F.octet_length("xml") <= FEED_BYTES)
    rss = small.filter(F.col("xml").rlike("(?i)<rss[ >]")).select("source", F.posexplode(F.from_xml("xml", RSS)["channel"]["item"]).alias("rank", "e"))
    rss = rss.select(
        "source", "rank", "e.title", F.col("e.link").alias("url"), F.col("e.pubDate").alias("pub_date"), F.col("e.source._VALUE").alias("source_label"),
        F.col("e.source._url").alias("source_url"), "e.description", F.coalesce(F.col("e.`content:encoded`"), F.col("e.description")).alias("raw_content"),
    )
    atom = small.filter(F.col("xml").rlike("(?i)<feed[ >]")).select("source", F.posexplode(F.from_xml("xml", ATOM)["entry"]).alias("rank", "e"))
    best = F.coalesce(F.get(F.filter("e.link", lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate")), F.lit(0)), F.get("e.link", F.lit(0)))
    atom = atom.select(
        "source", "rank", "e.title", best["_href"].alias("url"), F.coalesce("e.published", "e.updated").alias("pub_date"), F.lit(None).cast("string").alias("source_label"),
        F.lit(None).cast("string").alias("source_url"), F.col("e.summary").alias("description"), F.coalesce("e.content", "e.summary").alias("raw_content"),
    )
    return rss.unionByName(atom)


def published_at(text: Column, now: Column) -> Column:
    """RFC 2822 or ISO 8601; unreadable and future dates become ``now``."""
    plain = F.regexp_replace(F.trim(text), "^[A-Za-z]{3},\\s*", "")
    formats = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z")
    ways = [F.try_to_timestamp(plain, F.lit(f)) for f in formats]
    iso = F.when(F.trim(text).rlike("^[0-9]{4}-"), F.trim(text).try_cast("timestamp"))
    return F.least(F.coalesce(*ways, iso, now), now)


def raw_items(found: DataFrame, sources: DataFrame, now: Column, max_age_hours: int = V.MAX_AGE_HOURS, whole_titles: bool = False) -> DataFrame:
    """Entries of known sources (source, topic, label, domain, tier) that are young enough and have a title and a public URL.

    With ``whole_titles`` a title that ends like 'Headline - Source' isn't cut.
    """
    rows = found.join(sources, "source").withColumn("published_at", published_at(F.col("pub_date"), now))
    rows = rows.filter(F.col("published_at") >= now - F.expr(f"interval {max_age_hours} hours"))
    title, source = split_title(F.col("title"), F.col("source_label"))
    title = strip_markup(F.col("title")) if whole_titles else title
    url = normalize_public_url(F.col("url"))
    body = strip_markup(F.coalesce("raw_content", F.lit("")))
    hint = F.coalesce(F.nullif("description", F.lit("")), F.nullif("raw_content", F.lit("")), F.col("title"))
    rows = rows.select(
        "topic", title.alias("title"), source.alias("source_name"), F.coalesce(F.nullif(source_domain(url), F.lit("")), "domain").alias("source_domain"), url.alias("url"), "tier",
        "published_at", truncate_hint(hint).alias("summary_hint"), F.col("rank").alias("feed_rank"), F.when(F.length(body) >= V.BODY_CHARS, body).alias("feed_body"), "source",
    )
    return rows.filter((F.col("title") != "") & (F.col("url") != ""))


def discovered(results: DataFrame, seen: DataFrame) -> DataFrame:
    """Search results (url, provider_ord, ord, ...) of all providers, first of each URL, without those of ``seen`` (url); rank 9999, no age limit."""
    from ..operators.dedup import first_wins

    rows = results.withColumn("url", normalize_public_url(F.col("url"), allow_http=True)).filter("url <> ''")
    return first_wins(rows, ["url"], ["provider_ord", "ord"]).join(seen.select("url").distinct(), "url", "left_anti").withColumn("feed_rank", F.lit(9999))
