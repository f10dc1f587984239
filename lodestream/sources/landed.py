"""Landed feed files to items: one row a source with its state, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.text import strip_markup
from ..functions.urls import host, host_allowed, normalize_public_url, source_domain
from . import feeds

SEARCH_HOST = "news.google.com"


def scanned(sources: DataFrame, folder: str, most: int = feeds.FEED_BYTES) -> DataFrame:
    """``sources`` (source, file, ...) with ok, error, xml, from the files of a folder on any file system that Spark reads.

    A file that is missing or too large is an error of its source; the content of a file that is too large isn't read.
    """
    files = sources.sparkSession.read.format("binaryFile").load(folder).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "length", F.when(F.col("length") <= most, F.col("content")).alias("content"))
    rows = sources.join(files, "file", "left")
    error = F.when(F.col("length").isNull(), "file not found").when(F.col("length") > most, "body too large")
    xml = F.make_valid_utf8(F.col("content").cast("string"))
    return rows.withColumns({"error": error, "ok": error.isNull(), "xml": F.when(error.isNull(), xml)}).drop("length", "content")


def fetch_error(kind: Column, feed_url: Column, domain: Column, query: Column) -> Column:
    """Why a source may not be read, else null: by its strategy, the search feed's host or the source's own must be the one asked."""
    own = host(feed_url)
    bad = (normalize_public_url(feed_url) == "") | ~host_allowed(own, domain)
    return F.when(kind == "google-news-rss", F.lit(None)).when(kind.isin("rss", "json"), F.when(F.coalesce(bad, F.lit(True)), "unsafe URL")).otherwise("unknown strategy")


def ingested(sources: DataFrame, folder: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Raw items of all sources and their states. sources: topic, domain, label, tier, kind, feed_url, query, file.

    A search feed without a query (the topic 'all') has no items and no error; JSON sources are read as feeds.
    """
    return items_of(scanned(sources, folder), now)


def items_of(rows: DataFrame, now: Column, max_age_hours: int = V.MAX_AGE_HOURS, whole_titles: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw items and states of sources' files as they were read: topic, domain, label, tier, kind, feed_url, query, file, error, xml."""
    rows = rows.withColumn("source", F.concat_ws("|", "topic", "domain", "file"))
    refused = fetch_error(F.col("kind"), F.col("feed_url"), F.col("domain"), F.col("query"))
    silent = (F.col("kind") == "google-news-rss") & F.col("query").isNull()
    rows = rows.withColumn("error", F.when(~silent, F.coalesce(refused, F.col("error")))).withColumns({"ok": F.col("error").isNull(), "xml": F.when(F.col("error").isNull() & ~silent, F.col("xml"))})
    items = feeds.raw_items(feeds.entries(rows.filter("xml is not null").select("source", "xml")), rows.select("source", "topic", "label", "domain", "tier"), now, max_age_hours, whole_titles)
    return items, rows.select("topic", "domain", "kind", "ok", "error")


def search_results(landed: DataFrame, now: Column) -> DataFrame:
    """Search results (topic, url, title, domain, published_at, source_label, provider_ord, ord) of landed search feeds (topic, provider_ord, ok, xml, perhaps file); a failed one has none."""
    rows = landed.filter("ok and xml is not null").withColumn("source", F.concat_ws("|", "topic", "provider_ord", *(["file"] if "file" in landed.columns else [])))
    found = feeds.entries(rows.select("source", "xml")).join(rows.select("source", "topic", "provider_ord"), "source")
    url = normalize_public_url(F.col("url"), allow_http=True)
    return found.select(
        "topic", url.alias("url"), strip_markup(F.coalesce("title", F.lit(""))).alias("title"), source_domain(url).alias("domain"), feeds.published_at(F.col("pub_date"), now).alias("published_at"),
        F.nullif("source_label", F.lit("")).alias("source_label"), "provider_ord", F.col("rank").cast("long").alias("ord"),
    ).filter("url <> ''")
