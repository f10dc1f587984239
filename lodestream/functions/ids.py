"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normalize_title
from .urls import path_key


def fingerprint(title: Column, url: Column) -> Column:
    return F.concat(normalize_title(title), F.lit("|"), path_key(url))


def item_id(topic: Column, fp: Column) -> Column:
    return F.concat(topic, F.lit("-"), F.substring(F.sha2(fp, 256), 1, 32))


def doc_id(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 40)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def fact_id(cluster: Column, statement: Column, doc: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", cluster, statement, doc), 256), 1, 32)


def safe_doc_id(c: Column) -> Column:
    """Whether an id may name a stored document."""
    return c.rlike("^[0-9a-f]{40}$")


def cycle_start(ts: Column, hours: int = 6) -> Column:
    return F.window(ts, f"{hours} hours")["start"]
