"""Shared pieces of the training-data operators: table access, staging, let-binding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import shared_dir, staged  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body`` (a lambda over the bound column)."""
    return F.transform(F.array(value), body)[0]


#: Bytes of an Arrow batch that goes to Python, about; texts are long, and memory beside the heap grows with the batch.
BATCH = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to BATCH bytes, unless the session has a bound of its own. What an operator returns doesn't depend on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, "64m") in ("64m", "64MB", "67108864b", "67108864"):  # the default
        spark.conf.set(name, str(BATCH))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A key with more than one in so many rows is hot; there are fewer such keys than that, whatever the table.
HOT = 1000


def hot_join(rows: DataFrame, table: DataFrame, key: str, value: str, total: int, spread: Column) -> DataFrame:
    """``rows`` with the column ``value`` of ``table`` (key, value, n: a row for each key, rows of that key; null where there is none).

    Keys with more than total / HOT rows, fewer than HOT by that definition, are broadcast; their rows are dealt to the shuffle of
    the others by ``spread``, any column of the key's type, as are rows without a key, so no task gets a hot key.
    """
    hot = table.filter(F.col("n") * HOT > total).select(key, F.col(value).alias("_hot"))
    cold = table.filter(F.col("n") * HOT <= total).select(F.col(key).alias("_key"), F.col(value).alias("_cold"))
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("_key", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(spread))
    return rows.join(cold.hint("merge"), "_key", "left").withColumn(value, F.coalesce("_hot", "_cold")).drop("_key", "_hot", "_cold")
