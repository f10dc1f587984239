"""Files that tasks write in a shared folder: whole or not at all, whichever attempt of a task wrote them."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession

from .base import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared one, not made yet; a local one without ``file:``, as every reader knows it."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def plain(path: str) -> str:
    """A local path without its scheme; others as they are."""
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system (local, or what a URI names) and the path in it."""
    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(plain(path))
    return pafs.FileSystem.from_uri(path)


@contextlib.contextmanager
def whole(path: str) -> Iterator[pa.NativeFile]:
    """A stream whose bytes become the file at ``path`` once all are written; a second attempt replaces it by equal bytes."""
    where, name = place(path)
    folder, _, last = name.rpartition("/")
    where.create_dir(folder, recursive=True)
    own = f"{folder}/.{last}.{uuid.uuid4().hex}"  # readers pass over names with a dot
    try:
        with where.open_output_stream(own) as out:
            yield out
        where.move(own, name)
    except BaseException:
        with contextlib.suppress(OSError):
            where.delete_file(own)
        raise
