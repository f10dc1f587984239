"""First wins across cycles: keyed state that a stream keeps from one pass to the next, and that expires.

A key is new in a cycle if it wasn't seen in any cycle within the age limit before it; of a new key its first row of that cycle comes out. Every sighting
keeps a key known, so what comes out doesn't depend on how the input is cut into batches, as long as batches follow the arrival of cycles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from ..functions import values as V

#: Rows that a task keeps before it reduces them again.
HELD = 200_000
#: Buckets of keys whose state is one row each.
BUCKETS = 1024
_HOUR = 3_600_000_000


def _with_cycle(rows: DataFrame, time: str) -> DataFrame:
    """Adds _cycle, the number of the row's cycle since 1970; rows without a time belong to none and are left out."""
    return rows.filter(F.col(time).isNotNull()).withColumn("_cycle", F.expr(f"unix_micros({time}) div {V.CYCLE_HOURS * _HOUR}").cast("long"))


def first_sightings(rows: DataFrame, keys: list[str], order: list[str], time: str, hours: int = V.MAX_AGE_HOURS) -> DataFrame:
    """The batch form: of each key that wasn't seen for ``hours`` (whole cycles) the first row by ``order``, which begins with ``time``.

    A key's rows of a cycle are reduced before the shuffle (window group limit), so a key has a row a cycle.
    """
    first = Window.partitionBy(*keys, "_cycle").orderBy(*order)
    rows = _with_cycle(rows, time).withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
    before = F.lag("_cycle").over(Window.partitionBy(*keys).orderBy("_cycle"))
    return rows.withColumn("_before", before).filter(f"_before is null or _cycle - _before > {hours // V.CYCLE_HOURS}").drop("_before", "_cycle")


def stream_first_sightings(stream: DataFrame, keys: list[str], order: list[str], time: str, hours: int = V.MAX_AGE_HOURS, buckets: int = BUCKETS) -> DataFrame:
    """`first_sightings` over a stream. State: the last cycle of each key, dropped once the watermark is ``hours`` and a cycle past it.

    Each task reduces what it reads to a row for each key and cycle before the shuffle. Rows later than the watermark are dropped. State is kept for ``buckets`` of
    keys (by their hash) at a time, as one Arrow table each, so Python runs once a bucket and batch and not once a key; a stream's checkpoint keeps its number of buckets.
    """
    rows = _with_cycle(stream.withColumn(time, F.col(time).cast("timestamp")), time)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    columns, by = rows.columns, [*keys, "_cycle"]

    def least(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(parts).sort_values(order, kind="stable", na_position="first").drop_duplicates(by)

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, kept = [], 0, 0
        for b in batches:
            held.append(least([b]))
            n += len(held[-1])
            if n > kept + HELD:
                held = [least(held)]
                n = kept = len(held[0])
                if n > HELD:  # more keys than a task may hold: what is left is reduced behind the shuffle
                    yield held[0]
                    held, n, kept = [], 0, 0
        if held:
            yield least(held)

    limit = hours // V.CYCLE_HOURS

    def sighted(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else None
        if not state.hasTimedOut:
            mine = None
            for p in parts:
                mine = least([p] if mine is None else [mine, p])
            # a key's cycles in order behind the one that was known: a row is new where the one before it is too far back
            every = mine[by].assign(_at=range(len(mine)))
            every = every if seen is None else pd.concat([seen.assign(_at=-1), every], ignore_index=True)
            every = every.iloc[np.lexsort((every["_cycle"], every["_at"] >= 0))]
            before = every.groupby(keys, dropna=False, sort=False)["_cycle"].shift()
            new = (every["_at"] >= 0) & (before.isna() | (every["_cycle"] - before > limit))
            yield mine.iloc[every.loc[new, "_at"].to_numpy()][columns]
            seen = every[by].sort_values("_cycle", kind="stable").drop_duplicates(keys, keep="last")
        ends, now = (seen["_cycle"] + 1 + limit) * V.CYCLE_HOURS * _HOUR // 1000, state.getCurrentWatermarkMs()
        seen, ends = seen[ends > now], ends[ends > now]
        if seen.empty:
            state.remove()
            return
        table, sink = pa.Table.from_pandas(seen, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
        state.setTimeoutTimestamp(int(ends.min()))

    rows = rows.mapInPandas(reduced, rows.schema).withWatermark(time, f"{hours} hours")
    out = rows.groupBy("_bucket").applyInPandasWithState(sighted, rows.schema, "seen binary", "append", GroupStateTimeout.EventTimeTimeout)
    return out.drop("_cycle", "_bucket")
