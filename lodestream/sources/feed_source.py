"""Landed feeds as a Spark data source, and the registry by which other readers take their place.

``spark.read.format("landed_feeds").load(folder)`` has one row a feed file, FEEDS: a file that can't be read, or is too large, is a row with its
error, never a failed job. A folder holds a folder a source: ``<folder>/domain=<name>/...``. Partitions are planned by bytes from the listing, so
many small feeds share a task and no task gets more than PARTITION bytes or one file; filters on the source (=, in, begins with) choose the folders that are listed at all.

Any registered format with the columns of FEEDS may stand for a strategy: `ingested` reads each strategy's sources from its own format.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

from ..functions import values as V
from ..plans.staging import staged
from . import feeds, landed

FEEDS = "domain string, file string, bytes long, ok boolean, error string, xml string"
#: Bytes of files that a task reads, one file at least.
PARTITION = 16 << 20


class Found(NamedTuple):
    domain: str
    file: str  # below the folder
    size: int


@dataclass
class Files(InputPartition):
    found: list[Found]


def planned(found: list[Found], most: int) -> list[list[Found]]:
    """Files in order, cut into runs of at most ``most`` bytes or one file."""
    out: list[list[Found]] = []
    size = most
    for f in found:
        if not out or size + f.size > most:
            out.append([])
            size = 0
        out[-1].append(f)
        size += f.size
    return out


def _place(folder: str):
    """The file system and the path in it; a path without a scheme is local."""
    from pyarrow import fs

    if folder.startswith("file:") or "://" not in folder:
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


class LandedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.most = int(options.get("maxBytes", feeds.FEED_BYTES))
        self.partition = int(options.get("partitionBytes", PARTITION))
        self.wanted: list[tuple[str, tuple[str, ...]]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on the source are answered by the listing; all others are left to Spark."""
        for f in filters:
            kind = {EqualTo: "in", In: "in", StringStartsWith: "starts"}.get(type(f))
            if kind is None or tuple(f.attribute) != ("domain",) or f.value is None:
                yield f
            else:
                self.wanted.append((kind, tuple(v for v in f.value if v is not None) if isinstance(f, In) else (f.value,)))

    def _asked(self, domain: str) -> bool:
        return all(domain.startswith(v[0]) if kind == "starts" else domain in v for kind, v in self.wanted)

    def listed(self) -> list[Found]:
        """The feed files of the wanted sources, in order; hidden files are passed over. A folder that isn't there is empty."""
        from urllib.parse import unquote

        from pyarrow import fs

        where, root = _place(self.folder)
        out = []
        for top in where.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            domain = unquote(top.base_name.removeprefix("domain="))
            if top.type == fs.FileType.Directory and top.base_name.startswith("domain=") and self._asked(domain):
                for f in where.get_file_info(fs.FileSelector(top.path, recursive=True)):
                    if f.is_file and not f.base_name.startswith((".", "_")):
                        out.append(Found(domain, f.path[len(top.path) + 1 :], f.size))
        return sorted(out)

    def partitions(self) -> Sequence[InputPartition]:
        return [Files(p) for p in planned(self.listed(), self.partition)] or [Files([])]

    def read(self, partition: Files) -> Iterator:
        import pyarrow as pa
        from urllib.parse import quote

        where, root = _place(self.folder)
        schema = pa.schema([("domain", pa.string()), ("file", pa.string()), ("bytes", pa.int64()), ("ok", pa.bool_()), ("error", pa.string()), ("xml", pa.string())])
        tops = {}
        for f in partition.found:
            if f.domain not in tops:  # a writer may have escaped the name, or not
                plain = f"{root}/domain={f.domain}"
                tops[f.domain] = plain if where.get_file_info(plain).type.name == "Directory" else f"{root}/domain={quote(f.domain)}"
            error = xml = None
            if f.size > self.most:
                error = "body too large"
            else:
                try:
                    with where.open_input_stream(f"{tops[f.domain]}/{f.file}") as data:
                        xml = data.read(self.most + 1).decode("utf-8", "replace")
                except OSError as e:
                    error = f"unreadable: {type(e).__name__}"
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((f.domain, f.file, f.size, error is None, error, xml), schema.types)], schema=schema)


class LandedFeeds(DataSource):
    """Options: path (the folder), maxBytes (larger files are an error row), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "landed_feeds"

    def schema(self) -> str:
        return FEEDS

    def reader(self, schema) -> DataSourceReader:
        return LandedReader(self.options)


class Strategy(NamedTuple):
    """The registered format that reads the sources of a kind, and its options."""

    format: str
    options: dict[str, str]


def register(spark: SparkSession, *sources: type[DataSource]) -> None:
    """Make the landed feeds, and readers of a user's own, known to the session; filters may be pushed into them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for s in (LandedFeeds, *sources):
        spark.dataSource.register(s)


def read(spark: SparkSession, strategy: Strategy) -> DataFrame:
    """The rows of a strategy's format; one without the columns of FEEDS raises."""
    rows = spark.read.format(strategy.format).options(**strategy.options).load()
    names = [c.split()[0] for c in FEEDS.split(", ")]
    if missing := [c for c in names if c not in rows.columns]:
        raise ValueError(f"{strategy.format}: no column {', '.join(missing)}")
    return rows.select(*names)


def searched(spark: SparkSession, providers: list[Strategy], now: Column) -> DataFrame:
    """Search results (see `landed.search_results`) of all providers, in their order; a provider's rows are its feeds by topic (domain: the topic). A failed feed has none."""
    whole = None
    for i, p in enumerate(providers):
        part = read(spark, p).select(F.col("domain").alias("topic"), F.lit(i).alias("provider_ord"), "file", "ok", "xml")
        whole = part if whole is None else whole.unionByName(part)
    if whole is None:
        whole = spark.createDataFrame([], "topic string, provider_ord int, file string, ok boolean, xml string")
    return landed.search_results(staged(whole, "search-feeds"), now)


def ingested(sources: DataFrame, strategies: dict[str, Strategy], now: Column, max_age_hours: int = V.MAX_AGE_HOURS, whole_titles: bool = False) -> tuple[DataFrame, DataFrame]:
    """Raw items of all sources and their states: each kind's sources (see `landed.ingested`, without file) are read by its strategy.

    A source without any file is an error, and so is one of a kind without a strategy. Each file of a source is a feed with ranks of its own.
    ``whole_titles``: see `feeds.raw_items`.
    """
    spark, rows = sources.sparkSession, None
    for kind in sorted(strategies):
        mine = sources.filter(F.col("kind") == kind)
        found = read(spark, strategies[kind]).withColumnsRenamed({"ok": "_ok", "error": "_error"}).drop("bytes")
        part = mine.join(found, "domain", "left")
        rows = part if rows is None else rows.unionByName(part)
    other = sources.filter(~F.col("kind").isin(*sorted(strategies)))
    none = {"file": "string", "_ok": "boolean", "_error": "string", "xml": "string"}
    other = other.withColumns({c: F.lit(None).cast(k) for c, k in none.items()})
    rows = other if rows is None else rows.unionByName(other)
    error = F.when(~F.col("kind").isin(*sorted(strategies)), "unknown strategy").when(F.col("_ok").isNull(), "file not found").otherwise(F.col("_error"))
    return landed.items_of(staged(rows.withColumn("error", error).drop("_ok", "_error"), "feed-files"), now, max_age_hours, whole_titles)  # a file is read once
