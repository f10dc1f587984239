"""Cycles that may be replayed: what a batch of a stream adds to each cycle is written under the batch's number and counts once it is committed.

Layout of a folder: ``parts/cycle=<id>/batch=<n>/`` holds what batch n gave to a cycle; ``commits/<n>`` names the cycles of batch n. A batch that is written again (its
stream stopped between the write and its own checkpoint, or was started on an older checkpoint) overwrites its own parts alone, and one that has a commit
is passed over. Readers take committed parts only.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V


def cycle_id(time: str):
    """The start of a row's cycle, as the text that names it."""
    start = F.timestamp_micros(F.expr(f"unix_micros(cast({time} as timestamp)) div {V.CYCLE_HOURS * 3_600_000_000} * {V.CYCLE_HOURS * 3_600_000_000}"))
    return F.date_format(start, "yyyy-MM-dd'T'HH")


class CycleLog:
    """The folder of a stream's cycles."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("commits").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self, batch: int) -> bool:
        return self._fs().exists(self._path(f"commits/{batch}"))

    def write(self, rows: DataFrame, batch: int) -> bool:
        """Write and commit what ``batch`` adds (rows with a column cycle); False if it was committed already.

        The record appears whole, by a rename, after all its parts.
        """
        if self.committed(batch):
            return False
        rows = rows.withColumn("batch", F.lit(batch).cast("long"))
        rows.write.partitionBy("cycle", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.folder}/parts")
        cycles = [r[0] for r in rows.select("cycle").distinct().sort("cycle").collect()]  # names of a batch's cycles
        fs = self._fs()
        out = fs.create(self._path(f"commits/.{batch}"), True)
        out.write(bytearray(json.dumps({"batch": batch, "cycles": cycles}).encode()))
        out.close()
        if not fs.rename(self._path(f"commits/.{batch}"), self._path(f"commits/{batch}")):
            raise RuntimeError(f"batch {batch} couldn't be committed")
        return True

    def commits(self) -> DataFrame:
        """batch, cycle: one row for each cycle of each committed batch."""
        if not self._fs().exists(self._path("commits")):
            return self.spark.createDataFrame([], "batch long, cycle string")
        return self.spark.read.schema("batch long, cycles array<string>").json(f"{self.folder}/commits").select("batch", F.explode("cycles").alias("cycle"))

    def read(self, schema: str) -> DataFrame:
        """All committed parts, with cycle and batch. What a batch wrote and didn't commit isn't there."""
        commits = self.commits()
        if commits.isEmpty():
            return self.spark.createDataFrame([], f"{schema}, cycle string, batch long")
        parts = self.spark.read.schema(f"{schema}, cycle string, batch long").parquet(f"{self.folder}/parts")
        return parts.join(commits.distinct().hint("merge"), ["cycle", "batch"], "left_semi")


def run_cycles(stream: DataFrame, log: CycleLog, reduce: Callable[[DataFrame], DataFrame], checkpoint: str) -> None:
    """One pass over what has landed: ``reduce`` makes of a batch its rows by cycle (a column cycle), `CycleLog.write` keeps them, once."""

    def batch(rows: DataFrame, number: int) -> None:
        log.write(reduce(rows), number)

    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
