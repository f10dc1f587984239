"""An artifact as ordered shards of JSON lines with a manifest, so that neither a topic nor the run is one task's or one row's.

``<folder>/lines/section=<s>/topic=<t>/shard=<n>/`` holds the lines of the places from n * SHARD on, in order; ``<folder>/manifest`` has a row for each shard:
section, topic, shard, first, last, n, bytes. A reader knows from it what belongs to the artifact, and in which order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster, metrics
from ..operators.dedup import numbered
from .cycle import all_items
from .staging import staged

#: Lines of a shard.
SHARD = 10_000
MANIFEST = "section string, topic string, shard long, first long, last long, n long, bytes long"
LINES = "value string, section string, topic string, shard long"
PUBLIC = ["id", "topic", "title", "source", "source_domain", "url", "tier", "published_at", "summary_hint", "claims", "cluster_id", "mentions", "velocity"]


def _lines(rows: DataFrame, section: str, topic, pos: str, columns: list[str]) -> DataFrame:
    line = F.to_json(F.struct(F.col(pos).cast("long").alias("pos"), *columns), {"ignoreNullFields": "false"})
    return rows.select(F.lit(section).alias("section"), topic.alias("topic"), F.col(pos).cast("long").alias("pos"), line.alias("value"))


def sections(items: DataFrame, sources: DataFrame, floor: int) -> DataFrame:
    """section, topic, pos, value of the items (by topic and for 'all'), clusters, their members and the coverage of clustered, projected items.

    Members stand in a section of their own, so a cluster that holds a third of all items is no single line.
    """
    public = [c for c in PUBLIC if c in items.columns]
    own = F.col("topic")
    parts = [_lines(items, "items", own, "ord", public), _lines(all_items(items), "items", F.lit("all"), "pos", public)]
    heads = items.groupBy("topic", "cluster_id", "n").agg(
        F.count("*").alias("members"), F.countDistinct("source").alias("source_count"), F.countDistinct("source_domain").alias("distinct_domains"),
        F.min("published_at").alias("earliest"), F.max("published_at").alias("latest"), F.min_by("title", "ord").alias("headline"),
    )
    parts.append(_lines(heads, "clusters", own, "n", [c for c in heads.columns if c != "n"]))
    members = numbered(items.select("topic", "n", "ord", "cluster_id", "id"), ["topic"], ["n", "ord"], "pos")
    parts.append(_lines(members, "members", own, "pos", ["cluster_id", "id"]))
    coverage = staged(metrics.topic_coverage(sources, items, floor), "coverage")
    whole = coverage.unionByName(metrics.global_coverage(coverage, items).withColumn("topic", F.lit("all"))).withColumn("pos", F.lit(0))
    parts.append(_lines(whole, "coverage", own, "pos", [c for c in coverage.columns if c != "topic"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write(rows: DataFrame, folder: str, shard: int = SHARD) -> None:
    """Write `sections`. A shard is one task's file, of ``shard`` lines; shards are dealt by section, topic and place. A null topic is 'none'.

    Files, not bytes, are what takes time: shards are dealt to a set number of tasks, which adaptive execution would join to a few, and each task moves its own
    files to their place (committer 2), where the driver would move all of them one by one. What a failed job leaves isn't read, as the manifest comes last.
    """
    rows = rows.withColumns({"shard": F.expr(f"pos div {shard}"), "topic": F.coalesce("topic", F.lit("none"))})
    rows = staged(rows, "artifact-lines")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "section", "topic", "shard").sortWithinPartitions("section", "topic", "shard", "pos")
    dealt.select("value", "section", "topic", "shard").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("section", "topic", "shard").text(f"{folder}/lines")
    manifest = rows.groupBy("section", "topic", "shard").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    manifest.write.parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """section, topic, shard, pos, value of the shards that the manifest names; a shard whose lines aren't those it names fails the job."""
    if read_manifest(spark, folder).isEmpty():
        return spark.createDataFrame([], "section string, topic string, shard long, pos long, value string")
    lines = spark.read.schema(LINES).text(f"{folder}/lines").select("section", "topic", "shard", F.get_json_object("value", "$.pos").cast("long").alias("pos"), "value")
    keys = ["section", "topic", "shard"]
    found = lines.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(F.octet_length("value") + 1).alias("_bytes"))
    named = read_manifest(spark, folder).join(found.hint("merge"), keys, "left")
    good = (F.col("n") == F.coalesce("_n", F.lit(0))) & (F.col("bytes") == F.coalesce("_bytes", F.lit(0)))
    named = named.select(*keys, F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat_ws("/", F.lit("broken shard: "), *keys)).cast("boolean")).alias("good"))
    return lines.join(named.hint("merge"), keys).filter("good").drop("good")
