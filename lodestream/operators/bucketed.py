"""Document stores that a cycle can plug in: one interface, kept as tables in memory or as buckets of files.

A store knows documents by id (the first 40 digits of a SHA-256) and by the hash of their content. Puts are batches: of several puts of an
id the last counts, a put without a body leaves the body that is there, and a content hash belongs to the first id that brought it.

`BucketedStore` keeps three Parquet tables, each cut into fixed buckets by the first digits of its key, which is a hash already and so even
whatever the documents are. A put reads and rewrites only the buckets that its keys fall into (dynamic partition overwrite); lookups read only the buckets they ask for.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import staged
from . import store


class DocumentStore(ABC):
    """What a cycle asks of a store. Documents: id, content_hash and columns of the store's own; bodies are private and kept apart."""

    @abstractmethod
    def put(self, fresh: DataFrame) -> None:
        """Put documents (id, content_hash, arrival, perhaps body, and the store's columns). An id that may not name a document fails the put."""

    @abstractmethod
    def documents(self) -> DataFrame:
        """All stored documents."""

    @abstractmethod
    def by_id(self, ids: DataFrame) -> DataFrame:
        """The stored documents among ``ids`` (id)."""

    @abstractmethod
    def by_hash(self, hashes: DataFrame) -> DataFrame:
        """content_hash of ``hashes`` and the stored document that first brought it (what it is now); hashes that the index lacks, or whose document is gone, have no row."""

    @abstractmethod
    def bodies(self, ids: DataFrame) -> DataFrame:
        """id, body of those among ``ids`` (id) that have one."""

    def listing(self) -> DataFrame:
        """All stored ids, in order."""
        return store.listing(self.documents())

    def fresh(self, wanted: DataFrame, now: Column) -> DataFrame:
        """``wanted`` (id, perhaps etag and max_age in ms) with fresh: see `store.fresh_enough`. The store needs fetched_at, and etag if ``wanted`` has it."""
        held = self.by_id(wanted)
        column = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast("string")
        held = held.select("id", column(held, "etag").alias("_etag"), F.col("fetched_at").alias("_fetched"), F.lit(True).alias("_there"))
        age = F.col("max_age") if "max_age" in wanted.columns else F.lit(None).cast("long")
        rows = wanted.join(held, "id", "left")
        fetched = F.when(F.col("_there"), F.coalesce("_fetched", F.timestamp_seconds(F.lit(0))))
        return rows.withColumn("fresh", store.fresh_enough(column(wanted, "etag"), F.col("_etag"), fetched, now, age)).drop("_etag", "_fetched", "_there")


def _last(fresh: DataFrame, columns: list[str]) -> DataFrame:
    """The last put of each id, combined before the shuffle, so an id that a third of all puts have is no task of its own."""
    rest = [c for c in columns if c != "id"]
    return store.checked_ids(fresh).groupBy("id").agg(F.max_by(F.struct(*rest), "arrival").alias("r")).select("id", "r.*").select(*columns)


class TableStore(DocumentStore):
    """A store of tables that live as long as the session; each put stages them anew. For runs that keep nothing."""

    def __init__(self, spark: SparkSession, columns: str):
        self.schema = T.StructType.fromDDL(f"id string, content_hash string, {columns}")
        self.stored = spark.createDataFrame([], self.schema)
        self.index = spark.createDataFrame([], "content_hash string, id string")
        self.body = spark.createDataFrame([], "id string, body string")

    def put(self, fresh: DataFrame) -> None:
        fresh = staged(store.checked_ids(fresh), "puts")
        if "body" in fresh.columns:
            self.body = staged(store.bodies_upsert(self.body, fresh), "store-bodies")
        self.index = staged(self.index.unionByName(store.index_additions(self.index, fresh.filter("content_hash is not null"))), "store-index")
        last = _last(fresh, self.schema.names)
        self.stored = staged(self.stored.join(last.select("id").hint("merge"), "id", "left_anti").unionByName(last), "store-documents")

    def documents(self) -> DataFrame:
        return self.stored

    def by_id(self, ids: DataFrame) -> DataFrame:
        return self.stored.join(store.checked_ids(ids.select("id").distinct()).hint("merge"), "id", "left_semi")

    def by_hash(self, hashes: DataFrame) -> DataFrame:
        found = hashes.select("content_hash").distinct().join(self.index.hint("merge"), "content_hash")
        return found.join(self.stored.drop("content_hash").hint("merge"), "id").select("content_hash", *[c for c in self.stored.columns if c != "content_hash"])

    def bodies(self, ids: DataFrame) -> DataFrame:
        return store.body_of(ids, self.body)


class BucketedStore(DocumentStore):
    """A store of Parquet tables under ``folder``: documents and bodies in 16^``digits`` buckets by id, the index of hashes in as many by hash.

    ``columns``: the documents' columns beside id and content_hash. A bucket says which put wrote it last (generation). A bucket is written by ``parts`` tasks,
    so a store may have buckets larger than a task. A put first stages what the touched buckets will hold: should its job stop between
    buckets, the same put again leaves what one put leaves.
    """

    def __init__(self, spark: SparkSession, folder: str, columns: str, digits: int = 2, parts: int = 1):
        self.spark, self.folder, self.digits, self.parts = spark, folder, digits, parts
        kept = f"id string, content_hash string, {columns}, generation long"
        self.schemas = {"documents": kept, "bodies": "id string, body string", "index": "content_hash string, id string"}
        self.columns = [c for c in T.StructType.fromDDL(kept).names if c != "generation"]

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def table(self, name: str) -> DataFrame:
        """A table with its bucket; empty before the first put."""
        schema = f"{self.schemas[name]}, bucket string"
        path = self._path(name)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def bucket_of(self, key: Column) -> Column:
        return F.substring(key, 1, self.digits)

    def _within(self, name: str, keys: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
        """The table's rows in the buckets of ``keys``; buckets are a bounded list, so pruning needs no join."""
        touched = sorted(r[0] for r in keys.select(self.bucket_of(F.col(key))).distinct().collect() if r[0] is not None)
        return self.table(name).filter(F.col("bucket").isin(touched) if touched else F.lit(False)), touched

    def _write(self, rows: DataFrame, name: str, key: str, mode: str) -> None:
        rows = rows.withColumn("bucket", self.bucket_of(F.col(key)))
        deal = ["bucket"] if self.parts == 1 else ["bucket", F.pmod(F.xxhash64(key), F.lit(self.parts))]
        writer = rows.repartition(*deal).sortWithinPartitions("bucket").write.partitionBy("bucket").mode(mode)
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.folder}/{name}")

    def _upsert(self, name: str, last: DataFrame, generation: int | None) -> None:
        held, touched = self._within(name, last, "id")
        mark = {} if generation is None else {"generation": F.lit(generation).cast("long")}
        merged = held.drop("bucket", "generation").join(last.select("id").hint("merge"), "id", "left_anti").unionByName(last).withColumns(mark)
        if touched:
            self._write(staged(merged, f"store-{name}"), name, "id", "overwrite")

    def generation(self) -> int:
        """The last put, by its buckets; 0 before the first. Reads one number a bucket's file."""
        return int(self.table("documents").agg(F.max("generation")).first()[0] or 0)

    def put(self, fresh: DataFrame) -> None:
        fresh = staged(store.checked_ids(fresh), "puts")
        if "body" in fresh.columns:
            self._upsert("bodies", _last(fresh.filter("body is not null"), ["id", "body"]), None)
        hashed = fresh.filter("content_hash is not null")
        index, _ = self._within("index", hashed, "content_hash")
        added = staged(store.index_additions(index.select("content_hash", "id"), hashed), "store-index")
        if not added.isEmpty():
            self._write(added, "index", "content_hash", "append")
        self._upsert("documents", _last(fresh, self.columns), self.generation() + 1)

    def documents(self) -> DataFrame:
        return self.table("documents").drop("bucket")

    def by_id(self, ids: DataFrame) -> DataFrame:
        ids = store.checked_ids(ids.select("id").distinct())
        return self._within("documents", ids, "id")[0].drop("bucket").join(ids.hint("merge"), "id", "left_semi")

    def by_hash(self, hashes: DataFrame) -> DataFrame:
        hashes = hashes.select("content_hash").distinct()
        found = self._within("index", hashes, "content_hash")[0].select("content_hash", "id").join(hashes.hint("merge"), "content_hash", "left_semi")
        found = staged(found, "store-found")
        rows = self._within("documents", found, "id")[0].drop("bucket", "content_hash")
        return found.join(rows.hint("merge"), "id").select("content_hash", *[c for c in rows.columns])

    def bodies(self, ids: DataFrame) -> DataFrame:
        return self._within("bodies", ids, "id")[0].drop("bucket").join(store.checked_ids(ids.select("id").distinct()).hint("merge"), "id", "left_semi")
