"""The aggregation cycle: items to one reproducible artifact row."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.ids import fingerprint, item_id
from ..functions.text import claims, title_tokens
from ..operators import cluster, dedup, metrics
from .etl import PUBLIC, Etl
from .staging import staged


def run_id(now: str) -> str:
    """Reproducible from the pinned time."""
    return hashlib.sha256(f"lodestream:{now}".encode()).hexdigest()[:32]


def error_code(message: Column) -> Column:
    return (
        F.when(message.rlike("(?i)fetch|ECONNREFUSED|ENOTFOUND|timeout|ETIMEDOUT"), "NETWORK_ERROR").when(message.rlike("(?i)JSON|parse|Unexpected token"), "PARSE_ERROR")
        .when(message.rlike("schema|Schema"), "SCHEMA_ERROR").otherwise("UNKNOWN_ERROR")
    )


def items_of(raw: DataFrame, topic_rows: DataFrame) -> DataFrame:
    """Raw items (topic, title, url, source_domain, summary_hint, ...; arrival) deduplicated, with ids, claims and tokens."""
    rows = raw.withColumn("fingerprint", fingerprint(F.col("title"), F.col("url")))
    rows = dedup.first_wins(rows, ["topic", "fingerprint", "source_domain"], ["arrival"])
    rows = rows.join(F.broadcast(topic_rows.select("topic", "terms", "topic_ord")), "topic", "left")  # six rows
    return rows.withColumns(
        {
            "id": item_id(F.col("topic"), F.col("fingerprint")),
            "claims": claims(F.col("title"), F.col("summary_hint"), F.coalesce("terms", F.array().cast("array<string>"))),
            "tokens": title_tokens(F.col("title")),
        }
    )


def aggregated(raw: DataFrame, topic_rows: DataFrame) -> DataFrame:
    """Items with clusters, mentions and velocity."""
    return cluster.projected(cluster.clustered(cluster.seed_order(items_of(raw, topic_rows))))


def all_items(items: DataFrame) -> DataFrame:
    """The topic 'all': items of every topic by mentions (desc), topic and place, first of each id, with pos from 0 on; nothing is cut."""
    merged = dedup.global_merge(items.withColumns({"topic_ord": F.coalesce("topic_ord", F.lit(999)), "item_ord": F.col("ord")}))
    return dedup.numbered(merged, [], [F.desc("mentions"), "topic_ord", "topic", "item_ord"], "pos")


def artifact(spark: SparkSession, items: DataFrame, sources: DataFrame, now: str, floor: int = 20, found: Etl | None = None, said: DataFrame | None = None) -> DataFrame:
    """One row: the envelope as JSON (key ``artifact``) and its warnings. Collects per topic, at the edge, what is published: small by the budget of feeds.

    ``found``: documents, facts and warnings of the same items (see `etl`); a run with it has their maps and the higher revision. ``said``: messages of `log`.
    """
    public = F.struct("id", "topic", "title", "source", "source_domain", "url", "tier", "published_at", "summary_hint", "claims", "cluster_id", "mentions", "velocity")
    listed = items.select("topic", "ord", public.alias("i")).unionByName(all_items(items).select(F.lit("all").alias("topic"), F.col("pos").alias("ord"), public.alias("i")))
    by_topic = listed.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "i"))), lambda x: x["i"]).alias("items"))
    clusters = cluster.rollup(items)
    columns = F.struct(*[c for c in clusters.columns if c != "topic"])
    by_id = lambda a, b: F.when(a["cluster_id"] < b["cluster_id"], -1).when(a["cluster_id"] > b["cluster_id"], 1).otherwise(0)  # noqa: E731  maps have no order
    clusters = clusters.select("topic", columns.alias("c")).unionByName(clusters.select(F.lit("all").alias("topic"), columns.alias("c")))
    clusters = clusters.groupBy("topic").agg(F.array_sort(F.collect_list("c"), by_id).alias("clusters"))
    coverage = metrics.topic_coverage(sources, items, floor)
    coverage = staged(coverage.unionByName(metrics.global_coverage(coverage, items).withColumn("topic", F.lit("all"))), "coverage")
    rows = by_topic.join(clusters, "topic", "left").join(coverage, "topic", "left")
    warn = F.when(F.col("degraded"), F.concat(F.lit("topic "), "topic", F.lit(": "), F.col("distinct_domains").cast("string"), F.lit(" owners, below the floor")))
    cov = F.struct("configured", "queried", "responded", "distinct_domains", "degraded")
    one = rows.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic", "items")))).alias("itemsByTopic"),
        F.map_from_entries(F.collect_list(F.struct("topic", "clusters"))).alias("clustersByTopic"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic", cov.alias("c"))))).alias("coverageByTopic"), F.array_sort(F.collect_list(warn)).alias("warnings"),
    )
    data, warnings = ["itemsByTopic", "clustersByTopic", "coverageByTopic"], F.col("warnings")
    if found is not None:
        docs = found.documents.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("id", *[c for c in PUBLIC if c not in ("id", "topic")]))).alias("documents"))
        facts = found.facts.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "nth", "id", "statement", "entities", "quote", "metric", "value", "url", "source_domain", "corroboration", "confidence"))).alias("facts"))
        own = found.warnings.select("message")
        said = own if said is None else said.select("message").unionByName(own)
        docs = docs.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic", "documents")))).alias("documentsByTopic"))
        facts = facts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cluster_id", "facts")))).alias("factsByCluster"))
        for part in (docs, facts):  # one row each
            one = one.join(F.broadcast(part))
        data = [*data, "documentsByTopic", "factsByCluster"]
    if said is not None:
        one = one.join(F.broadcast(said.agg(F.array_sort(F.collect_list("message")).alias("said"))))  # one row
        warnings = F.concat("warnings", "said")
    head = envelope_head(now, found is not None)
    literal = [F.lit(v).alias(k) for k, v in head.items() if not isinstance(v, (dict, list))] + [F.struct(*[F.lit(x).alias(k) for k, x in head["cycle"].items()]).alias("cycle")]
    literal.append(F.from_json(F.lit(json.dumps(head["topics"])), "array<struct<id:string,label:string>>").alias("topics"))
    body = F.to_json(F.struct(*literal, warnings.alias("warnings"), F.struct(*data).alias("data")), {"ignoreNullFields": "false"})
    return one.select(body.alias("artifact"), F.size(warnings).alias("n_warnings"))


def envelope_head(now: str, with_facts: bool = False) -> dict:
    """Version, run, topics and cycle of an artifact whose time is pinned to ``now`` (ISO 8601, UTC)."""
    import datetime as dt

    t = dt.datetime.fromisoformat(now.replace("Z", "+00:00"))
    start = t.replace(hour=t.hour // V.CYCLE_HOURS * V.CYCLE_HOURS, minute=0, second=0, microsecond=0)
    show = lambda x: x.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    cycle = {"id": show(start), "windowStart": show(start), "windowEnd": show(start + dt.timedelta(hours=V.CYCLE_HOURS))}
    names = [{"id": t[0], "label": t[1]} for t in V.TOPICS]
    revision = V.REVISION if with_facts else V.REVISION - 1
    return {
        "schemaVersion": V.SCHEMA_VERSION, "contractRevision": revision, "artifact": "aggregation", "runId": run_id(now), "upstreamRunId": None, "generatedAt": show(t), "cycle": cycle, "topics": names,
    }


def hermetic(spark: SparkSession, now: str) -> DataFrame:
    """The empty artifact of a run without network: byte-identical for one time."""
    body = envelope_head(now) | {"warnings": ["no network: empty artifact"], "data": {"itemsByTopic": {}, "clustersByTopic": {}, "coverageByTopic": {}}}
    return spark.createDataFrame([(json.dumps(body, sort_keys=True),)], "artifact string")


def checked(artifact_json: str) -> list[str]:
    """Warnings of a compatible artifact; another version or kind raises."""
    body = json.loads(artifact_json)
    if body.get("schemaVersion") != V.SCHEMA_VERSION or body.get("artifact") != "aggregation":
        raise ValueError("incompatible artifact")
    return ["newer revision"] if body.get("contractRevision", 0) > V.REVISION else []


def describe(df: DataFrame, found: Etl | None = None) -> str:
    """The schemas of what a run publishes: items, and documents and facts if they are made."""
    parts = {"items": df} | ({} if found is None else {"documents": found.documents.select(*PUBLIC), "facts": found.facts})
    return json.dumps({k: json.loads(v.schema.json()) for k, v in parts.items()}, sort_keys=True)


def log(states: DataFrame, discovered: DataFrame, removed: DataFrame) -> DataFrame:
    """topic, message of what a run warns of before articles: failed sources (topic, domain, ok, error), new domains (topic, domain, tier, credibility), repeats removed (topic, removed)."""
    where = F.concat(F.lit("["), "topic", F.lit("] "))
    failed = states.filter("not ok").select("topic", F.concat(where, F.lit("source "), "domain", F.lit(": "), "error").alias("message"))
    new = discovered.select("topic", F.concat(where, F.lit("new domain discovered: "), "domain", F.format_string(" (tier=%s, credibility=%s)", "tier", F.col("credibility").cast("string")), F.lit(", for review")).alias("message"))
    repeats = removed.filter("removed > 0").select("topic", F.concat(where, F.format_string("%d exact repeats removed", F.col("removed").cast("long"))).alias("message"))
    return failed.unionByName(new).unionByName(repeats)


def summary(items: DataFrame) -> DataFrame:
    """topic, items, clusters, domains: the run in short."""
    return items.groupBy("topic").agg(F.count("*").alias("items"), F.countDistinct("cluster_id").alias("clusters"), F.countDistinct("source_domain").alias("domains")).orderBy("topic")


def exit_code(warnings: list[str]) -> int:
    """1 if the final guard dropped facts; the artifact is written all the same."""
    return int(any(w.startswith("[A5]") for w in warnings))


def publish(frames: dict[str, DataFrame], folder: str, run: str) -> None:
    """Write the tables of a run under ``folder`` and, once all are there, make it the current one; readers see the last good run or this one, never parts."""
    spark = next(iter(frames.values())).sparkSession
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/runs/{run}/{name}")
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{folder}/{p}")
    fs = path("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path("CURRENT.next"), True)
    out.write(bytearray(run.encode()))
    out.close()
    fs.delete(path("CURRENT"), False)
    if not fs.rename(path("CURRENT.next"), path("CURRENT")):
        raise RuntimeError(f"the run {run} couldn't be made current")


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the current run (of the one about to be, should a writer have stopped between its last two steps)."""
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(f"{folder}/{p}")
    fs = path("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    run = spark.read.text(f"{folder}/CURRENT" if fs.exists(path("CURRENT")) else f"{folder}/CURRENT.next").first()[0]
    return spark.read.parquet(f"{folder}/runs/{run}/{name}")
