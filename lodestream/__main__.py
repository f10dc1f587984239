"""Command line: one aggregation cycle over landed tables, to a file or to standard output."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import math
import sys

from .functions import values as V


def number(default: float):
    """A number, zero included; what is none, or no number at all, gives the default."""

    def read(text: str) -> float:
        try:
            value = float(text)
        except ValueError:
            return default
        return default if math.isnan(value) or math.isinf(value) else value

    return read


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestream")
    p.add_argument("--tables", help="folder with pages.parquet")
    p.add_argument("--feeds", "--fixtures", help="folder of landed feeds, domain=<name>/...; needs --catalog")
    p.add_argument("--catalog", help="JSON file of the sources")
    p.add_argument("--in", dest="ignored", help="accepted and ignored: this stage has no input before it")
    p.add_argument("--now", help="pinned time, ISO 8601")
    p.add_argument("--run-id", help="pinned id of the run")
    p.add_argument("--out", default="-", help="file for the artifact, or - for standard output")
    p.add_argument("--floor", type=number(20), default=20, help="distinct owners that a topic needs")
    p.add_argument("--max-age-hours", type=number(V.MAX_AGE_HOURS), default=V.MAX_AGE_HOURS, help="older items are left out")
    p.add_argument("--concurrency", type=number(10), default=10, help="fetches at once in the schedule")
    p.add_argument("--slots", help="folder for the schedule of fetches (with --robots)")
    p.add_argument("--robots", help="folder of robots files as JSON lines (host, text)")
    p.add_argument("--no-network", action="store_true", help="the empty artifact")
    p.add_argument("--with-facts", "--etl", action="store_true", help="read article bodies and mine facts")
    p.add_argument("--etl-budget", type=number(V.BUDGET), default=V.BUDGET, help="articles a topic")
    p.add_argument("--provider", default="deterministic", help="who mines facts; only the rules are built in")
    p.add_argument("--store", help="folder of a document store that cycles share (with --with-facts)")
    p.add_argument("--shards", help="folder for the artifact as ordered shards of JSON lines with a manifest, instead of one file")
    p.add_argument("--describe", action="store_true", help="the schemas of what a run publishes")
    p.add_argument("--json-errors", action="store_true", help="errors as JSON on standard output")
    return p


def from_feeds(spark, catalog_file: str, folder: str, now: str, hours: int):
    """Raw items, in the order of their sources and ranks, of the catalogue's sources from landed feeds, and the states of these."""
    from pyspark.sql import functions as F

    from .sources import catalog, feed_source

    topics = catalog.topics(spark)
    found = catalog.by_topic(catalog.with_meta_feeds(catalog.sources(catalog.read_catalog(spark, catalog_file)), topics))
    sources = found.join(F.broadcast(topics.select("topic", F.col("label").alias("query"))), "topic")  # six rows
    feed_source.register(spark)
    feeds = feed_source.Strategy("landed_feeds", {"path": folder})
    items, states = feed_source.ingested(sources, {"rss": feeds, "google-news-rss": feeds}, F.lit(now).cast("timestamp"), hours)
    return items.withColumn("arrival", F.struct("source", "feed_rank", "url")).withColumn("source", F.col("source_name")), states


def failure(code: str, message: str, to=sys.stderr) -> int:
    print(json.dumps({"error": {"code": code, "message": message, "stage": "aggregation"}}), file=to)
    return 2


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    errors = sys.stdout if args.json_errors else sys.stderr
    now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    try:
        dt.datetime.fromisoformat(now.replace("Z", "+00:00"))
    except ValueError:
        return failure("INVALID_ARGUMENT", f"--now isn't a time: {now}", errors)
    if not (args.no_network or args.tables or (args.feeds and args.catalog)):
        return failure("INVALID_ARGUMENT", "--tables, --feeds with --catalog, or --no-network is needed", errors)
    if args.provider != "deterministic":
        print(f"provider {args.provider} isn't there: facts by rules", file=sys.stderr)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from .functions import urls
    from .operators import bucketed
    from .plans import cycle, etl, queries, sink, staging
    from .sources import catalog, robots

    spark = SparkSession.builder.appName("lodestream").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.no_network:
        row = cycle.hermetic(spark, now).first()
    else:
        raw, states = from_feeds(spark, args.catalog, args.feeds, now, int(args.max_age_hours)) if args.feeds else (queries.page_items(spark, args.tables), None)
        items = staging.staged(cycle.aggregated(raw, catalog.topics(spark)), "run-items")
        found = None
        if args.slots and args.robots:
            ruled = robots.rules(spark.read.schema("host string, text string").json(args.robots))
            wanted = items.select("url", urls.host(F.col("url")).alias("host"), urls.part(F.col("url"), 3).alias("path"), F.col("url").alias("id")).distinct()
            wanted = robots.allowed(wanted, ruled).filter("allowed").select("host", "url")
            robots.fetch_slots(wanted, ruled, ["url"], max(1, int(args.concurrency))).write.mode("overwrite").json(args.slots)
        if args.with_facts:
            pages = spark.read.parquet(f"{args.tables}/pages.parquet").select("url", "html") if args.tables else spark.createDataFrame([], "url string, html string")
            nothing = spark.createDataFrame([], "id string, extraction string, access_policy string, word_count long, lang string, content_hash string, body string")
            items = items if "feed_body" in items.columns else items.withColumn("feed_body", F.lit(None).cast("string"))
            budget = int(args.etl_budget)
            found = etl.run_with_store(items, bucketed.BucketedStore(spark, args.store, etl.STORED), pages, budget=budget) if args.store else etl.run(items, nothing, pages, budget=budget)
        if args.describe:
            print(json.dumps(json.loads(cycle.describe(items, found)), indent=2))
            return 0
        sources = items.groupBy("topic", "source").agg(F.lit(True).alias("ok")) if states is None else states.select("topic", F.col("domain").alias("source"), "ok")
        if args.shards:
            sink.write(sink.sections(items, sources, int(args.floor)), args.shards)
            return 0 if found is None else cycle.exit_code([r["message"] for r in found.warnings.filter("kind = 'A5'").limit(1).collect()])
        row = cycle.artifact(spark, items, sources, now, int(args.floor), found).first()
        for s in cycle.summary(items).collect():
            print(f"{s['topic']}: {s['items']} items, {s['clusters']} clusters, {s['domains']} domains", file=sys.stderr)
    warnings = cycle.checked(row["artifact"]) + json.loads(row["artifact"])["warnings"]
    whole = json.loads(row["artifact"]) | ({"runId": args.run_id} if args.run_id else {})
    body = json.dumps(whole, indent=2, ensure_ascii=False)
    if args.out != "-":
        with open(args.out, "w", encoding="utf-8") as f:
            f.write(body + "\n")
    else:
        print(body)
    return cycle.exit_code(warnings)


if __name__ == "__main__":
    sys.exit(main())
