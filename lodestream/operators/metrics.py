"""Engagement metrics and source coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.urls import owner_domain, registrable_domain


def metric_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[_\-\t\n\x0B\f\r ]", "")


def forbidden_key(c: Column) -> Column:
    """Whether a metric's name tells of persons or sessions."""
    key = metric_key(c)
    hit = F.lit(False)
    for f in V.FORBIDDEN_FRAGMENTS:
        hit = hit | F.contains(key, F.lit(f))
    return hit


def metric_of(c: Column) -> Column:
    """shares, comments, reactions or null."""
    key, out = metric_key(c), None
    for name, keys in V.METRICS.items():
        out = F.when(key.isin(*keys), name) if out is None else out.when(key.isin(*keys), name)
    return F.when(~forbidden_key(c), out)


def interaction(entries: Column) -> Column:
    """struct(shares, comments, reactions) from array<struct<key, value>>; the last entry of a metric wins."""

    def last(name: str) -> Column:
        own = F.filter(entries, lambda e: metric_of(e["key"]) == name)
        return F.when(F.size(own) > 0, F.element_at(own, -1)["value"]).cast("double").alias(name)

    return F.struct(*[last(n) for n in V.METRICS])


def topic_coverage(sources: DataFrame, items: DataFrame, floor: int) -> DataFrame:
    """One row a topic: configured, queried, responded (sources: topic, source, ok), distinct owners (items: topic, source_domain), degraded."""
    s = sources.groupBy("topic").agg(F.count("*").alias("configured"), F.count("*").alias("queried"), F.count_if("ok").alias("responded"))
    i = items.groupBy("topic").agg(F.countDistinct(registrable_domain(owner_domain(F.col("source_domain")))).alias("distinct_domains"))
    d = F.coalesce("distinct_domains", F.lit(0))
    return s.join(i, "topic", "left").withColumn("distinct_domains", d).withColumn("degraded", d < floor)


def global_coverage(coverage: DataFrame, items: DataFrame) -> DataFrame:
    """Sums over topics; owners counted anew over all items; never degraded."""
    sums = coverage.agg(*[F.sum(c).alias(c) for c in ("configured", "queried", "responded")])
    owners = items.agg(F.countDistinct(registrable_domain(owner_domain(F.col("source_domain")))).alias("distinct_domains"))
    return sums.join(F.broadcast(owners)).withColumn("degraded", F.lit(False))  # one row each
