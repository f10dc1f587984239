"""Cycles over a stream: tumbling six-hour windows, late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V


def cycle_counts(events: DataFrame, time: str = "ts") -> DataFrame:
    """cycle_start, event_type, n; batch or stream. Rows later than the age limit are dropped from a stream."""
    if events.isStreaming:
        # watermarks need an instant: zoneless times are read in the session's zone
        events = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, f"{V.MAX_AGE_HOURS} hours")
    # the window itself is the key: its start alone would have no watermark, and no cycle would ever be finished
    counts = events.groupBy(F.window(time, f"{V.CYCLE_HOURS} hours").alias("cycle"), "event_type").agg(F.count("*").alias("n"))
    return counts.select(F.col("cycle.start").alias("cycle_start"), "event_type", "n")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """One pass over what has landed; finished cycles are appended to Parquet at ``path``, each exactly once by the checkpoint.

    A cycle is finished when the watermark has passed its end: rows later than that are dropped, and its state goes. Cycles that are still
    open stay in the state and appear in a later pass.
    """
    out = stream.writeStream.format("parquet").option("path", path).outputMode("append").option("checkpointLocation", checkpoint)
    out.trigger(availableNow=True).start().awaitTermination()
