"""First-wins deduplication in arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.staging import staged


def first_wins(df: DataFrame, keys: list[str], arrival: list[Column | str]) -> DataFrame:
    """The row of each key that arrived first. The limit of one row a key is pushed below the shuffle (window group limit)."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*arrival))
    return df.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def duplicates_removed(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, kept, removed. Keys are combined before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count("*").alias("kept")).withColumn("removed", F.col("n_rows") - F.col("kept"))


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among ``seen``, first of each key by arrival columns the caller has applied."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def global_merge(items: DataFrame, k: int | None = None) -> DataFrame:
    """Items of all topics by mentions (desc), topic and item order; first of each id."""
    order = [F.desc("mentions"), "topic_ord", "item_ord"]
    out = first_wins(items, ["id"], order)
    return out.orderBy(*order).limit(k) if k else out


def fetch_budget(members: DataFrame, budget: int) -> DataFrame:
    """Members (topic, cluster_ord, member_ord, url) within the topic's running budget; a URL counts once a cluster."""
    once = first_wins(members, ["topic", "cluster_ord", "url"], ["member_ord"])
    nth = F.row_number().over(Window.partitionBy("topic").orderBy("cluster_ord", "member_ord"))
    return once.withColumn("nth", nth).filter(F.col("nth") <= budget)


def numbered(df: DataFrame, keys: list[str], order: list[Column | str], name: str) -> DataFrame:
    """``df`` with ``name``, each row's number from 0 on within its keys by ``order`` (total but for equal rows); no key is one task.

    Rows are dealt by ranges of keys and order, sorted, and written; a number is the row's place among its range's rows of the key plus what the
    ranges before hold. Only counts (a row for each range and key) meet in one place.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k) for k in keys] + [o if isinstance(o, Column) else F.col(o) for o in order]
    rows = staged(df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_range", F.shiftright("_place", 33))
    held = rows.groupBy(*keys, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select(*keys, "_range", (before - F.col("_first")).alias("_add"))
    return rows.join(held, [*keys, "_range"]).withColumn(name, (F.col("_place") + F.col("_add")).cast("long")).drop("_place", "_range", "_add")
