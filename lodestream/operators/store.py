"""Document store over tables: upserts, first-writer hash index, lookups, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import safe_doc_id


def checked_ids(rows: DataFrame) -> DataFrame:
    """``rows``; an id that may not name a document fails the job."""
    return rows.withColumn("id", F.when(safe_doc_id(F.col("id")), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("unsafe document id: "), F.coalesce(F.substring("id", 1, 80), F.lit("null")))).cast("string")))


def upsert(stored: DataFrame, fresh: DataFrame, arrival: str = "arrival") -> DataFrame:
    """``stored`` with rows of ``fresh`` put in by id, the last by ``arrival`` of each; unsafe ids fail the job."""
    last = checked_ids(fresh).groupBy("id").agg(F.max_by(F.struct(*[c for c in stored.columns if c != "id"]), arrival).alias("r")).select("id", "r.*").select(*stored.columns)
    return stored.join(last.select("id"), "id", "left_anti").unionByName(last)


def bodies_upsert(bodies: DataFrame, fresh: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The private table of bodies (id, body) after puts: a put without a body leaves the one that is there."""
    return upsert(bodies.select("id", "body"), fresh.filter("body is not null").select("id", "body", arrival), arrival)


def index_additions(index: DataFrame, fresh: DataFrame) -> DataFrame:
    """content_hash, id of the first writer of each hash that the index lacks (fresh: content_hash, id, arrival)."""
    first = fresh.groupBy("content_hash").agg(F.min_by("id", "arrival").alias("id"))
    return first.join(index, "content_hash", "left_anti")


def current_index(lines: DataFrame) -> DataFrame:
    """The last line of each hash wins (content_hash, id, line)."""
    return lines.groupBy("content_hash").agg(F.max_by("id", "line").alias("id"))


def read_index(lines: DataFrame) -> DataFrame:
    """content_hash, id, line from an index's raw lines (value: a JSON object with hash and id; line: its number); malformed lines are passed over."""
    row = F.from_json("value", "hash string, id string", {"mode": "PERMISSIVE"})
    return lines.select(row["hash"].alias("content_hash"), row["id"].alias("id"), "line").filter("content_hash is not null and id is not null")


def by_hash(hashes: DataFrame, index: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored documents by content hash (hashes: content_hash), through the index; a hash it lacks, or whose document is gone, has none."""
    found = hashes.select("content_hash").distinct().join(index.select("content_hash", "id"), "content_hash")
    return stored.join(checked_ids(found).select("id"), "id", "left_semi")


def body_of(wanted: DataFrame, bodies: DataFrame) -> DataFrame:
    """Bodies (id, body) of ``wanted`` (id); unsafe ids fail the job."""
    return bodies.join(checked_ids(wanted.select("id").distinct()), "id", "left_semi")


def listing(stored: DataFrame) -> DataFrame:
    """All stored ids, in order."""
    return stored.select("id").distinct().orderBy("id")


def looked_up(items: DataFrame, stored: DataFrame) -> DataFrame:
    """Items with hit: the store has their document, and its extraction didn't fail."""
    s = stored.select("id", F.col("extraction").alias("stored_extraction"))
    return items.join(s, "id", "left").withColumn("hit", F.coalesce(F.col("stored_extraction") != "failed", F.lit(False)))


def fresh_enough(etag: Column, stored_etag: Column, fetched: Column, now: Column, max_age: Column) -> Column:
    """Equal etags (not empty) are fresh; else the age decides, if a bound is given; else being stored."""
    age = F.unix_millis(now) - F.unix_millis(fetched)
    same = F.coalesce((etag != "") & (etag == stored_etag), F.lit(False))
    return F.when(fetched.isNull(), False).when(same, True).when(max_age.isNotNull(), age < max_age).otherwise(True)
