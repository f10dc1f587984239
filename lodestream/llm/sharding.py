"""Longest-processing-time sharding.

Rows of equal text form a group that must stay in one shard. Groups go, largest first, to the
shard with the least load so far, which a heap gives. Groups of one size are interchangeable
for that rule, so the driver needs only the histogram (group size, number of groups): its length D
obeys D * D / 2 <= total bytes, since D different sizes sum to that at least (under 1.5e7 entries
at 100 TB, some ten thousand in practice). Which group of a size goes where is decided by its rank in a
distributed sort. Nothing else reaches the driver, and no shard is ever one task.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .base import hot_join, partitions, staged

#: Row numbers inside a shard are dealt in so many strips, by two digits of a hash of id and text, so that no shard is one task.
STRIPS = 256
OVERHEAD = 16
_PER_PART = 33  # bits that monotonically_increasing_id leaves for the row in a partition


def deal(histogram: list[tuple[int, int]], n_shards: int) -> list[tuple[int, int, list[int], list[int]]]:
    """LPT over (size, count) runs: (size, rank of its first group, cumulative counts, shards).

    Short runs pop and push the heap group by group. A long run of equal sizes takes the ``count``
    smallest values of the sequences load + k * size, which is where the heap would end as well.
    """
    heap = [(0, s) for s in range(n_shards)]
    out, rank = [], 0
    for size, count in sorted(histogram, reverse=True):
        given: dict[int, int] = {}
        if count <= 8 * n_shards:
            for _ in range(count):
                load, s = heap[0]
                heapq.heapreplace(heap, (load + size, s))
                given[s] = given.get(s, 0) + 1
        else:
            loads = sorted(heap, key=lambda x: x[1])
            low, high = loads[0][0], max(x for x, _ in loads) + size * count
            low = min(x for x, _ in loads) - 1

            def below(top: int) -> int:
                return sum(max(0, (top - x) // size + 1) for x, _ in loads if top >= x)

            while high - low > 1:  # the highest level at which no more than count are placed
                mid = (low + high) // 2
                low, high = (mid, high) if below(mid) <= count else (low, mid)
            given = {s: (low - x) // size + 1 for x, s in loads if low >= x}
            rest = count - sum(given.values())
            for x, s in loads:  # ties at the next level, by shard
                if rest and x + given.get(s, 0) * size == low + 1:
                    given[s] = given.get(s, 0) + 1
                    rest -= 1
            heap = [(x + given.get(s, 0) * size, s) for x, s in loads]
            heapq.heapify(heap)
        shards = sorted(given)
        ends, total = [], 0
        for s in shards:
            total += given[s]
            ends.append(total)
        out.append((size, rank, ends, shards))
        rank += count
    return out


def shard_by_size(docs: DataFrame, n_shards: int = 40, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    size: UTF-8 bytes of the text plus 16. A null text counts as an empty one (size 16, crc 0) and
    shares its group. A null id is an id like any other. Repeated rows are rows of their own with
    slots of their own. An empty table gives no rows. Other columns are ignored.
    Ties among equal sizes go by the text's SHA-256 (of a run of equal sizes the first in that order have the shards of the lowest
    numbers), ties among equal loads by the shard's number. Slots follow the strip, the id and the text's SHA-256. Texts of any length count whole.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("k"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("k").agg(F.sum("size").alias("load"), F.count("*").alias("n"))
    ranked = staged(
        groups.repartitionByRange(partitions(spark), F.desc("load"), "k")
        .sortWithinPartitions(F.desc("load"), "k")
        .select("k", "load", "n", F.monotonically_increasing_id().alias("at")),
        "shard-groups",
    ).select("k", "load", "n", F.shiftright("at", _PER_PART).alias("part"), F.col("at").bitwiseAND(2**_PER_PART - 1).alias("nth"))
    before, total = [], 0
    for part, n in sorted((r[0], r[1]) for r in ranked.groupBy("part").count().collect()):  # one row a partition
        before.append((part, total))
        total += n
    sizes = ranked.groupBy("load").count().toArrow()  # 16 bytes for each different size
    plan = deal(list(zip(sizes["load"].to_pylist(), sizes["count"].to_pylist())), n_shards)
    before_df = spark.createDataFrame(before, "part long, before long")
    kinds = {"load": pa.int64(), "first": pa.int64(), "ends": pa.list_(pa.int64()), "shards": pa.list_(pa.int32())}
    plan_df = spark.createDataFrame(pa.table({c: pa.array([run[i] for run in plan], kind) for i, (c, kind) in enumerate(kinds.items())}))
    held = ranked.groupBy("load").count().join(plan_df.hint("merge"), "load").select("load", F.struct("first", "ends", "shards").alias("run"), F.col("count").alias("n"))
    # a size that very many texts have, and a text that very many rows have, are in many tasks
    sized = hot_join(ranked.withColumnRenamed("n", "copies"), held, "load", "run", total, F.xxhash64("k")).join(F.broadcast(before_df), "part")
    placed = sized.withColumn("r", F.col("before") + F.col("nth") - F.col("run.first")).select("k", F.expr("run.shards[size(filter(run.ends, e -> e <= r))]").alias("shard"), F.col("copies").alias("n"))
    placed = staged(placed, "shard-placed")
    strip = F.conv(F.substring(F.sha2(F.concat_ws(":", "doc_id", F.lower(F.hex("k"))), 256), 1, 2), 16, 10).cast("int")
    rows = hot_join(rows, placed, "k", "shard", placed.agg(F.sum("n")).first()[0] or 0, F.xxhash64("doc_id").cast("string").cast("binary"))
    dealt = staged(rows.withColumn("strip", strip), "shard-dealt")
    strips = dealt.groupBy("shard", "strip").count()  # n_shards * STRIPS rows at most
    strips = strips.withColumn(
        "skip", F.sum("count").over(Window.partitionBy("shard").orderBy("strip").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")
    ).select("shard", "strip", "skip")
    nth = F.row_number().over(Window.partitionBy("shard", "strip").orderBy("doc_id", "k"))
    return (
        dealt.withColumn("nth", nth)
        .join(F.broadcast(strips), ["shard", "strip"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("skip") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
        )
    )
