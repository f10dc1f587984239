"""Source catalogue and topics as dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.text import strings
from ..functions.urls import source_domain

SCHEMA = "name string, owner string, category string, tier int, sourceType string, feedUrl string, type string, verified boolean, lastChecked string"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path, multiLine=True)


def topics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b, list(c), d, i) for i, (a, b, c, d) in enumerate(V.TOPICS)], "topic string, label string, terms array<string>, diversity_floor int, topic_ord int")


def tier_of(tier, source_type, category):
    security = category == "Security/Vulnerabilities"
    return (
        F.when(source_type == "preprint", "paper").when(tier == 1, "primary").when(security, "security-news")
        .when((tier == 2) & (F.coalesce(source_type, F.lit("")) != "press"), "technical-news").otherwise("news")
    )


def sources(catalog: DataFrame) -> DataFrame:
    """domain, label, tier, topics, feed_url, credibility of verified https RSS and Atom entries."""
    rows = catalog.filter(F.coalesce("verified", F.lit(True)) & F.col("feedUrl").startswith("https://") & (F.coalesce("type", F.lit("")) != "JSON"))
    named = None
    for category, names in V.CATEGORY_TOPICS.items():
        named = F.when(F.col("category") == category, strings(names)) if named is None else named.when(F.col("category") == category, strings(names))
    domain = F.coalesce(F.nullif(source_domain(F.col("feedUrl")), F.lit("")), F.substring("feedUrl", 1, 80))
    credibility = F.when(F.col("tier") == 1, 0.9).when(F.col("tier") == 2, 0.75).otherwise(0.65)
    return rows.select(
        domain.alias("domain"), F.col("name").alias("label"), tier_of(F.col("tier"), F.col("sourceType"), F.col("category")).alias("tier"),
        named.otherwise(strings(("platform",))).alias("topics"), F.col("feedUrl").alias("feed_url"), F.lit("rss").alias("kind"), credibility.alias("credibility"),
    )


def with_meta_feeds(found: DataFrame, topic_rows: DataFrame, host: str = "news.google.com") -> DataFrame:
    """One search feed for each topic but 'all' joins the catalogue's sources."""
    meta = topic_rows.filter("topic <> 'all'").select(
        F.lit(host).alias("domain"), F.concat(F.lit("News search: "), "label").alias("label"), F.lit("news").alias("tier"), F.array("topic").alias("topics"),
        F.lit(None).cast("string").alias("feed_url"), F.lit("google-news-rss").alias("kind"), F.lit(0.75).alias("credibility"),
    )
    return found.unionByName(meta)


def by_topic(found: DataFrame) -> DataFrame:
    """topic and source, one row a pair; 'all' has no sources of its own."""
    return found.select(F.explode("topics").alias("topic"), *[c for c in found.columns if c != "topics"]).filter("topic <> 'all'")
