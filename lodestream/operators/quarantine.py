"""Malformed input: good rows go on, bad rows are kept with the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def screened(rows: DataFrame, column: str, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with parsed (a struct of ``schema``, null for bad rows) and reason (null for good ones), from the JSON text in ``column``.

    Reasons, the first that holds: empty (null or blank), not JSON, not an object, wrong type (a value that its type can't hold), missing: <name> (a required
    field that isn't there or null). Fields that the schema doesn't name are passed over.
    """
    text = F.col(f"`{column}`")
    names = T.StructType.fromDDL(schema).names
    read = F.from_json(text, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    variant = F.try_parse_json(text)
    rows = rows.withColumns({"_read": read, "_kind": F.schema_of_variant(variant)})
    reason = (
        F.when(text.isNull() | (F.trim(text) == ""), "empty").when(F.col("_kind").isNull(), "not JSON").when(~F.col("_kind").startswith("OBJECT"), "not an object")
        .when(F.col("_read._corrupt").isNotNull(), "wrong type")
    )
    for name in required:
        reason = reason.when(F.col("_read")[name].isNull(), f"missing: {name}")
    parsed = F.struct(*[F.col("_read")[n].alias(n) for n in names])
    return rows.withColumn("reason", reason).withColumn("parsed", F.when(F.col("reason").isNull(), parsed)).drop("_read", "_kind")


def parted(rows: DataFrame, column: str, schema: str, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Good rows with parsed, and the quarantine: bad rows as they came, with reason. Together they are all rows, each once."""
    told = screened(rows, column, schema, required)
    return told.filter("reason is null").drop("reason"), told.filter("reason is not null").drop("parsed")
