"""From clustered items to public documents, guarded facts and warnings: the part of a cycle that reads article bodies.

Everything is one plan over tables: the budget picks URLs, the store, the feeds and landed pages give bodies, eligible bodies are
mined, and two guards drop what may not be published. What went wrong becomes rows of a warnings table, never a failed job.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions import values as V
from ..functions.urls import host, normalize_public_url
from ..operators import dedup, extract, facts
from ..operators.bucketed import DocumentStore
from .staging import staged

SEARCH_HOST = "news.google.com"
PUBLIC = ["topic", "cluster_id", "id", "url", "source", "source_domain", "tier", "title", "published_at", "extraction", "access_policy", "word_count", "lang", "content_hash"]
WARNING = ["topic", "cluster_id", "kind", "message"]
ITEM = ["topic", "cluster_id", "url", "source", "source_domain", "tier", "title", "published_at", "summary_hint", "ord"]


class Etl(NamedTuple):
    documents: DataFrame  # PUBLIC and the private column body, with its origin
    facts: DataFrame  # what passed both guards
    screened: DataFrame  # all facts with their violation, null for those that passed
    warnings: DataFrame  # WARNING


def budgeted(items: DataFrame, budget: int = V.BUDGET) -> DataFrame:
    """Items (topic, n: the cluster's number, ord, url, ...) whose articles the topic's budget covers; a URL counts once a cluster."""
    members = items.withColumns({"cluster_ord": F.col("n"), "member_ord": F.col("ord")})
    return dedup.fetch_budget(members, budget).drop("cluster_ord", "member_ord", "nth")


def exhausted(items: DataFrame, within: DataFrame, budget: int = V.BUDGET) -> DataFrame:
    """topic, cluster_id, fetched, members of the clusters that the budget cut short; nothing is left out in silence."""
    wanted = items.groupBy("topic", "cluster_id").agg(F.count("*").alias("members"), F.countDistinct("url").alias("urls"))
    got = within.groupBy("topic", "cluster_id").agg(F.count("*").alias("fetched"))
    rows = wanted.join(got, ["topic", "cluster_id"], "left").withColumn("fetched", F.coalesce("fetched", F.lit(0)))
    return rows.filter("fetched < urls").select("topic", "cluster_id", "fetched", "members")


def _landed(rows: DataFrame, body: Column, extraction: Column) -> DataFrame:
    """Documents of bodies that were there without a fetch."""
    rows = rows.withColumn("body", body)
    return rows.withColumns(
        {
            "id": ids.doc_id(F.col("url")), "extraction": extraction, "access_policy": F.lit("allowed"), "word_count": text.space_words(F.col("body")), "lang": F.lit("en"),
            "content_hash": ids.content_hash(F.col("body")),
        }
    )


def documents(within: DataFrame, feeds: DataFrame, stored: DataFrame, pages: DataFrame) -> DataFrame:
    """PUBLIC, body and origin of each item of ``within``: the store's document (unless it failed), the feed's body, a search feed's hint, the landed page.

    feeds: topic, url, feed_body, arrival; stored: id, extraction, access_policy, word_count, lang, content_hash, body; pages: url, html,
    and allowed (by robots), content_type, if there. A search feed's item without a hint of 50 characters has the origin none and no document.
    """
    known = stored.filter("extraction <> 'failed'").select(F.col("id").alias("s_id"), F.struct("extraction", "access_policy", "word_count", "lang", "content_hash", "body").alias("s"))
    bodies = dedup.first_wins(feeds.filter("feed_body is not null"), ["topic", "url"], ["arrival"]).select("topic", "url", "feed_body")
    rows = within.select(*ITEM).withColumn("s_id", ids.doc_id(F.col("url"))).join(known, "s_id", "left").join(bodies, ["topic", "url"], "left")
    hint = F.trim(F.coalesce("summary_hint", F.lit("")))
    origin = (
        F.when(F.col("s").isNotNull(), "store").when(F.length("feed_body") >= 100, "feed")
        .when(host(F.col("url")) == SEARCH_HOST, F.when(F.length(hint) >= 50, "hint").otherwise("none")).otherwise("fetch")
    )
    rows = staged(rows.withColumn("origin", origin), "etl-origins")
    out = [*PUBLIC, "body", "origin"]
    store = rows.filter("origin = 'store'").select("*", F.col("s_id").alias("id"), "s.*")
    feed = _landed(rows.filter("origin = 'feed'"), F.col("feed_body"), F.when(F.length("body") >= 500, "full").otherwise("snippet"))
    brief = _landed(rows.filter("origin = 'hint'"), hint, F.lit("snippet"))
    asked = rows.filter("origin = 'fetch'")
    pages = pages.join(asked.select("url").distinct(), "url", "left_semi")  # texts of other pages aren't moved
    asked = asked.join(pages, "url", "left")
    fetched = extract.documents(asked, [*ITEM, "origin"])
    none = rows.filter("origin = 'none'").select("*", *[F.lit(None).cast(k).alias(c) for c, k in (("id", "string"), ("extraction", "string"), ("access_policy", "string"), ("word_count", "long"), ("lang", "string"), ("content_hash", "string"), ("body", "string"))])
    whole = None
    for part in (store, feed, brief, fetched, none):
        whole = part.select(*out) if whole is None else whole.unionByName(part.select(*out))
    return whole


def run(items: DataFrame, stored: DataFrame, pages: DataFrame, provided: DataFrame | None = None, budget: int = V.BUDGET) -> Etl:
    """The whole part. items: clustered, with feed_body and arrival; ``provided``: facts of another extractor (see `facts.chosen`)."""
    items = staged(items.select(*ITEM, "n", "feed_body", "arrival"), "etl-items")  # read several times: without this, the clusters' joins run each time
    within = staged(budgeted(items, budget), "etl-within")
    docs = staged(documents(within, items.select("topic", "url", "feed_body", "arrival"), stored, pages), "etl-documents")
    # two addresses may be one once they are normalised: the first text counts
    mined = dedup.first_wins(extract.eligible(docs.filter("id is not null")), ["cluster_id", "id"], ["url", "content_hash"])
    mined = mined.select("topic", "cluster_id", F.col("id").alias("doc_id"), "source_domain", "url", "body")
    found, reasons = facts.chosen(mined, provided)
    shaped = facts.valid(facts.corroborated(found, mined))
    bodies = mined.select("cluster_id", "doc_id", "body")
    rows = shaped.join(bodies, ["cluster_id", "doc_id"], "left").withColumn("verbatim", facts.overlaps(F.col("statement"), F.col("body"))).drop("body")
    rows = staged(facts.guarded(rows.withColumn("provenance_count", F.when(F.col("doc_id").isNotNull(), 1).otherwise(0))), "etl-facts")
    where = F.concat(F.lit("["), "topic", F.lit("/"), "cluster_id", F.lit("] "))
    warn = lambda df, kind, message: df.select("topic", "cluster_id", F.lit(kind).alias("kind"), F.concat(where, message).alias("message"))
    clusters = items.select("topic", "cluster_id").distinct()
    parts = [
        warn(exhausted(items, within, budget), "budget", F.format_string(f"fetch budget exhausted ({budget}): %d of %d fetched", "fetched", "members")),
        warn(docs.filter("origin = 'none'"), "search", F.concat(F.lit("search redirect without a body: "), "url")),
        warn(docs.filter("access_policy = 'robots-disallowed'"), "robots", F.concat(F.lit("robots-disallowed: "), "url")),
        warn(docs.filter("access_policy = 'paywalled' and origin = 'fetch'"), "paywall", F.concat(F.lit("paywalled, snippet alone: "), "url")),
        warn(docs.filter("extraction = 'failed' and access_policy <> 'robots-disallowed'"), "fetch", F.concat(F.lit("fetch failed: "), "url")),
        warn(clusters.join(mined.select("topic", "cluster_id").distinct(), ["topic", "cluster_id"], "left_anti"), "empty", F.lit("no extractable bodies: no facts")),
        warn(reasons, "provider", F.col("reason")),
        warn(rows.filter("violation = 'schema'"), "schema", F.concat(F.lit("fact "), "id", F.lit(": dropped by the schema"))),
        rows.filter("violation is not null and violation <> 'schema'").select("topic", "cluster_id", F.lit("A5").alias("kind"), F.concat(F.lit("[A5] fact "), "id", F.lit(": "), "violation", F.lit(", dropped")).alias("message")),
    ]
    warnings = parts[0]
    for p in parts[1:]:
        warnings = warnings.unionByName(p)
    clean = rows.filter("violation is null").drop("violation", "verbatim", "provenance_count")
    return Etl(docs.filter("id is not null"), clean, rows, warnings)


#: The columns of a document store that cycles share, beside id and content_hash.
STORED = "url string, extraction string, access_policy string, word_count long, lang string"


def run_with_store(items: DataFrame, kept: DocumentStore, pages: DataFrame, provided: DataFrame | None = None, budget: int = V.BUDGET) -> Etl:
    """`run` against a store that outlives the cycle (its columns: STORED): its documents are looked up by the items' ids, and what this cycle made is put into it.

    A document that failed is put, too, and is tried again in the next cycle. Only the buckets of the items' ids are read or written. Items and pages
    go by the URL that a fetched document is stored under, without its fragment; of several pages with one such URL the one without a fragment counts, else the first.
    """
    safe = normalize_public_url(F.col("url"))
    address = F.when(safe != "", safe).otherwise(F.col("url"))
    items = items.withColumn("url", address)
    wanted = staged(items.select(ids.doc_id(F.col("url")).alias("id"), "url").filter("id is not null").distinct(), "etl-wanted")
    pages = pages.withColumns({"_landed": F.col("url"), "url": address}).join(wanted.select("url"), "url", "left_semi")
    pages = dedup.first_wins(pages, ["url"], [F.col("_landed") != F.col("url"), "_landed"]).drop("_landed")
    known = kept.by_id(wanted).join(kept.bodies(wanted).hint("merge"), "id", "left")
    known = staged(known.select("id", "extraction", "access_policy", "word_count", "lang", "content_hash", "body"), "etl-known")
    got = run(items, known, pages, provided, budget)
    fresh = got.documents.filter("origin <> 'store'").withColumn("arrival", F.struct(F.col("extraction") != "failed", "topic", "cluster_id", "url"))  # of equal ids one that failed comes first
    kept.put(fresh.select("id", "content_hash", "url", "extraction", "access_policy", "word_count", "lang", "body", "arrival"))
    return got
