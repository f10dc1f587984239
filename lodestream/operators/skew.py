"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many rows is hot; there are fewer such keys than that, whatever the table.
HOT = 1000


def with_value(rows: DataFrame, table: DataFrame, keys: list[str], value: str, total: int, spread: Column | None = None) -> DataFrame:
    """``rows`` with the column ``value`` of ``table`` (keys, value, n: a row for each key, and how many rows have it); null where there is none.

    Keys with more than total / HOT rows, fewer than HOT of them by that definition, are broadcast; their rows are dealt to the shuffle of all others by
    ``spread`` (a long; the row's hash if none is given), as are rows with a null among the keys, so no task gets a hot key.
    """
    hot = table.filter(F.col("n") * HOT > total).select(*keys, F.col(value).alias("_hot"), F.lit(True).alias("_is_hot"))
    cold = table.filter(F.col("n") * HOT <= total).select(F.hash(*keys).cast("long").alias("_h"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_cold"))
    rows = rows.join(F.broadcast(hot), keys, "left")
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if not c.startswith("_")]) if spread is None else spread
    bound = F.col("_is_hot").isNull()
    for k in keys:
        bound = bound & F.col(k).isNotNull()
    rows = rows.withColumns({"_h": F.when(bound, F.hash(*keys).cast("long")).otherwise(spread)} | {f"_k{i}": F.when(bound, F.col(k)) for i, k in enumerate(keys)})
    on = ["_h", *[f"_k{i}" for i in range(len(keys))]]
    out = rows.join(cold.hint("merge"), on, "left").withColumn(value, F.coalesce("_hot", "_cold"))
    return out.drop("_hot", "_is_hot", "_cold", *on)
