"""Rewriting Parquet files whose schemas have drifted into one evolved schema, in constant memory.

A table is a folder of Parquet files whose columns are known by field ids, not by names or places. `rewrite` gives every file the
evolved schema: a task takes one file at a time, makes a column plan from the file's field ids, reads batches of its row groups, casts,
fills what is missing, appends to a Parquet writer and feeds the digests of what it has written. Files that have the evolved schema
already stay untouched.

What a task writes lies beside the table until all tasks are done; then each new file takes its old one's place by a rename, in tasks
of their own. Both steps may be repeated by lost executors or second attempts: a file is written whole or not at all, from a starting file
that no task of that step changes, and a rename that has happened isn't asked for twice.
"""

from __future__ import annotations

import contextlib
import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .base import partitions, small_batches, staged

_ID = b"PARQUET:field_id"
#: Rows of a row group that is written, and of a batch that is read.
GROUP, BATCH = 1 << 16, 1 << 13


def field_id(field: pa.Field) -> int | None:
    raw = (field.metadata or {}).get(_ID)
    return None if raw is None else int(raw)


def with_id(field: pa.Field, number: int) -> pa.Field:
    return field.with_metadata({_ID: str(number).encode()})


class Step(NamedTuple):
    """Where a column of the evolved schema comes from: a file's column, or a constant where the file has none of its id."""

    field: pa.Field
    source: int | None
    fill: object


def plan(found: pa.Schema, evolved: pa.Schema, fills: dict[int, object]) -> list[Step]:
    """How a file of the schema ``found`` becomes ``evolved``, by field ids; missing columns take ``fills`` by id, else null.

    A file that names an id twice, or has a column without one, raises.
    """
    at: dict[int, int] = {}
    for i, f in enumerate(found):
        n = field_id(f)
        if n is None or n in at:
            raise ValueError(f"column {f.name}: {'no field id' if n is None else f'field id {n} stands twice'}")
        at[n] = i
    return [Step(f, at.get(field_id(f)), fills.get(field_id(f))) for f in evolved]


def evolved_already(found: pa.Schema, evolved: pa.Schema) -> bool:
    """Whether names, places, types, nullability and ids are the evolved ones."""
    same = lambda f, g: (f.name, f.type, f.nullable, field_id(f)) == (g.name, g.type, g.nullable, field_id(g))
    return len(found) == len(evolved) and all(same(f, g) for f, g in zip(found, evolved))


def apply(batch: pa.RecordBatch, steps: list[Step], evolved: pa.Schema) -> pa.RecordBatch:
    """A batch cast and filled; nulls stay. A value that its type can't hold raises."""
    columns = []
    for field, source, fill in steps:
        if source is None:
            columns.append(pa.nulls(len(batch), field.type) if fill is None else pa.array([fill], field.type).take(pa.array(np.zeros(len(batch), np.int32))))
        else:
            columns.append(batch.column(source).cast(field.type))
    return pa.RecordBatch.from_arrays(columns, schema=evolved)


class Digest:
    """An incremental SHA-256 of values that a separator parts."""

    def __init__(self, separator: bytes):
        self.hash, self.separator, self.begun = hashlib.sha256(), separator, False

    def add(self, values: pa.Array) -> None:
        if len(values):
            one = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            data = pc.binary_join(one, self.separator.decode())[0].as_buffer()
            if self.begun:
                self.hash.update(self.separator)
            self.hash.update(data)
            self.begun = True

    def hex(self) -> str:
        return self.hash.hexdigest()


def shown(column: pa.Array, null: str = "?") -> pa.Array:
    """A column as text: instants as microseconds since 1970, doubles as floor(2^20 * value), null as ``null``; NaN and infinities as Python shows them."""
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64())
    elif pa.types.is_floating(column.type):
        scaled = pc.floor(pc.multiply(column.cast(pa.float64()), 1048576.0))
        safe = pc.less(pc.abs(scaled), 2.0**62)
        if pc.all(pc.fill_null(safe, True)).as_py():
            column = scaled.cast(pa.int64())
        else:  # beyond 64 bits
            column = pa.array([None if v is None else str(int(v)) if math.isfinite(v) else str(v) for v in scaled.to_pylist()], pa.string())
    return pc.fill_null(column.cast(pa.string()), null)


class Summary:
    """What is told of a file: rows, nulls, digests of its first column and of its rows."""

    def __init__(self):
        self.rows, self.nulls, self.ids, self.lines = 0, 0, Digest(b","), Digest(b"\n")

    def add(self, batch: pa.RecordBatch) -> None:
        text = [shown(c) for c in batch.columns]
        self.rows += len(batch)
        self.nulls += sum(c.null_count for c in batch.columns)
        self.ids.add(text[0])
        self.lines.add(pc.binary_join_element_wise(*text, "|"))


#: What `rewrite` returns: the table's file, where its new version waits (null: untouched), and its Summary.
RESULT = "path string, waiting string, n_rows long, n_nulls long, ids_sha256 string, rows_sha256 string, start_columns string, columns string, rewritten boolean"


def _rewritten(evolved: pa.Schema, fills: dict[int, object], waiting: str):
    """Rows (path) of files to RESULT; a file's new version is written under ``waiting``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, name = files.place(path)
                with where.open_input_file(name) as data:
                    source = pq.ParquetFile(data)
                    found, told, new = source.schema_arrow, Summary(), None
                    groups = (b for g in range(source.num_row_groups) for b in source.iter_batches(BATCH, row_groups=[g]))
                    if evolved_already(found, evolved):
                        for b in groups:
                            told.add(b)
                    else:
                        steps, new = plan(found, evolved, fills), f"{waiting}/{name.rpartition('/')[2]}"
                        with files.whole(new) as out, pq.ParquetWriter(out, evolved) as writer:
                            for rows in _grouped(apply(b, steps, evolved) for b in groups):
                                writer.write_batch(rows, GROUP)
                                for at in range(0, len(rows), BATCH):
                                    told.add(rows.slice(at, BATCH))
                names = lambda s: ",".join(s.names)
                row = {
                    "path": path, "waiting": new, "n_rows": told.rows, "n_nulls": told.nulls, "ids_sha256": told.ids.hex(), "rows_sha256": told.lines.hex(),
                    "start_columns": names(found), "columns": names(evolved if new else found), "rewritten": new is not None,
                }
                yield pa.RecordBatch.from_pylist([row], _RESULT)

    return run


_RESULT = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[k]) for n, k in (c.split() for c in RESULT.split(", "))])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to GROUP rows, about."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= GROUP:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of RESULT whose new files have taken the old ones' places."""
    for batch in batches:
        for path, waiting in zip(batch.column("path").to_pylist(), batch.column("waiting").to_pylist()):
            if waiting is not None:
                where, name = files.place(waiting)
                with contextlib.suppress(FileNotFoundError):  # an earlier attempt has moved it
                    where.move(name, files.place(path)[1])
        yield batch


def rewrite(table: DataFrame, evolved: pa.Schema, fills: dict[int, object], waiting: str) -> DataFrame:
    """Give the files of ``table`` (path: one row a file) the evolved schema; RESULT and the other columns of ``table``.

    Rows keep their order, nulls stay, columns that a file lacks take ``fills`` by field id. Files that have the schema already aren't touched. New
    files wait in the folder ``waiting``, which no reader of the table looks into, until all are written. A file is one task's work, in batches; files are
    dealt to many tasks. No files give no rows.
    """
    n = 2 * partitions(table.sparkSession)
    done = staged(table.select("path").repartition(n, "path").mapInArrow(_rewritten(evolved, fills, waiting), RESULT), "rewritten")
    moved = done.repartition(n, "path").mapInArrow(_moved, RESULT)
    return staged(table.join(moved.hint("merge"), "path"), "rewrite-done")


def write_files(rows: DataFrame, folder: str, drift: Callable[[int], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, size: int) -> DataFrame:
    """Write rows (r: their number from 0 on, and the columns of ``schema``) to files of ``size`` rows in ``folder``, by r; file_no, path.

    ``drift`` gives each file's number the function that turns its batches into those of its schema. Files are dealt to tasks by their numbers, and
    a task streams its rows in order, so it holds one row group of one file.
    """
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
            for batch in batches:
                number = batch.column("file_no").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
                for a, b in zip(cuts, cuts[1:]):
                    if a < b:
                        yield int(number[a]), batch.slice(a, b - a).select(columns)

        rest, row = parts(), None
        row = next(rest, None)
        while row is not None:
            number, path = row[0], f"{folder}/part-{row[0]:08d}.parquet"
            turn = drift(number)

            def own() -> Iterator[pa.RecordBatch]:
                nonlocal row
                while row is not None and row[0] == number:
                    yield turn(row[1])
                    row = next(rest, None)

            groups = _grouped(own())
            first = next(groups)
            with files.whole(path) as out, pq.ParquetWriter(out, first.schema) as writer:
                writer.write_batch(first, GROUP)
                for g in groups:
                    writer.write_batch(g, GROUP)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([path], pa.string())], ["file_no", "path"])

    numbered = rows.select(F.expr(f"r div {size}").alias("file_no"), "r", *columns)
    n = 2 * partitions(rows.sparkSession)
    dealt = numbered.repartitionById(n, F.pmod("file_no", F.lit(n)).cast("int")).sortWithinPartitions("r").select("file_no", *columns)
    return staged(dealt.mapInArrow(run, "file_no long, path string"), "table-files")


# The query's table: its columns, and how its starting files drift.
CLIENT_ROWS = "client_id long, master_id long, source string, updated_at {time}, name string, email string, city string, nation_id long, segment string, balance double"


def client_schema(zone: str | None) -> pa.Schema:
    """The evolved schema, field ids 1 to 10; updated_at has ``zone``, or none."""
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "{time}": pa.timestamp("us", zone)}
    return pa.schema([with_id(pa.field(c.split()[0], kinds[c.split()[1]]), i) for i, c in enumerate(CLIENT_ROWS.split(", "), 1)])


FILLS = {8: -1, 9: "none"}
#: Files that a table is cut into, at most, and the name of the drift's hash.
FILES, DRIFT = 250, "19"


def version(file_no: int) -> int:
    v = zlib.crc32(f"{DRIFT}:{file_no}".encode()) % 24
    return 0 if v > 15 else v


def drifted(evolved: pa.Schema) -> Callable[[int], Callable[[pa.RecordBatch], pa.RecordBatch]]:
    """How a file of ``evolved`` has drifted: by the bits of its number's version."""

    def of(file_no: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        bits = version(file_no)
        fields = {i: f for i, f in enumerate(evolved, 1)}
        if bits & 1:
            fields[5], fields[6] = fields[5].with_name("email"), fields[6].with_name("name")
        if bits & 8:
            fields[8], fields[10] = fields[8].with_type(pa.int32()), fields[10].with_type(pa.float32())
        if bits & 4:
            del fields[8], fields[9]
        order = [1, *sorted(set(fields) - {1}, reverse=bool(bits & 2))]
        schema = pa.schema([fields[i] for i in order])

        def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
            # the loss of a balance's last digits is the drift
            columns = [batch.column(i - 1).cast(f.type, safe=not pa.types.is_float32(f.type)) for i, f in zip(order, schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        return turn

    return of


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with r, their number from 0 on by the unsigned CRC-32 of the decimal client_id, then client_id (none: first), then all columns."""
    from ..operators.dedup import numbered

    crc = F.crc32(F.col("client_id").cast("string").cast("binary"))
    rest = [c for c in rows.columns if c != "client_id"]
    rows = rows.withColumns({"_crc": F.coalesce(crc, F.lit(-1)), "_all": F.xxhash64(*rest), "_m": F.monotonically_increasing_id()})
    return numbered(rows, [], ["_crc", F.col("client_id").asc_nulls_first(), "_all", "_m"], "r").drop("_crc", "_all", "_m")


def drifted_clients(clients: DataFrame) -> DataFrame:
    """Lay ``clients`` out as a drifted table in a new folder, rewrite it there, and tell of each final file.

    An updated_at without a zone stays so. Rows without an id come first; repeated rows are kept. An empty table has no files and gives no rows. Other columns,
    whatever their names, are left behind. A column that is missing in a starting file has neither null nor value left: it is filled.
    """
    spark = clients.sparkSession
    small_batches(spark)
    time = dict(clients.dtypes)["updated_at"]
    schema, evolved = CLIENT_ROWS.format(time=time), client_schema(None if time == "timestamp_ntz" else "UTC")
    rows = in_order(clients.select(*[F.col(n).cast(k).alias(n) for n, k in (c.split() for c in schema.split(", "))]))
    folder = files.new_folder(spark, "drifted-clients")
    made = write_files(rows, f"{folder}/table", drifted(evolved), schema, 1 + rows.count() // FILES)
    done = rewrite(made, evolved, FILLS, f"{folder}/waiting")
    local = F.when(F.col("path").startswith("file:"), F.regexp_replace("path", "^file:/+", "/")).otherwise(F.col("path"))
    v = F.pmod(F.crc32(F.concat(F.lit(f"{DRIFT}:"), F.col("file_no").cast("string")).cast("binary")), F.lit(24)).cast("long")
    return done.select(
        "file_no", F.when(v > 15, 0).otherwise(v).cast("long").alias("version"), "n_rows", "n_nulls", "ids_sha256", "rows_sha256", "start_columns", "columns", local.alias("path"), "rewritten",
    )
