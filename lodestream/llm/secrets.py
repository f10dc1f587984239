"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every historical version of every path is addressed by the SHA-256 of its text. A blob is one row
from then on, however many paths and versions share it. The ledger says which rule versions have
read which blob, and every span in it names the rule version that found it; only (blob, rule version)
pairs it lacks are scanned. Findings of the wanted rule versions alone are joined back to all paths by the
blob's address, so what a replaced or removed rule found is neither shown nor lost.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import HOT, hot_join, let, staged


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 0  # shorter matches are dropped
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns. A run of one class is greedy, so a bound on its length may stand in the pattern.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", 1, r"[0-9a-f]{32,}", base=True),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("ghtoken", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
_NONE = "array<struct<kind:int,i:int,gap:int,len:int,bgap:int,blen:int,ok:boolean>>"
_SPANS = "array<struct<start:int,kind:int,end:int>>"
#: A ledger's columns. ``spans``: what those rules found, in code points, end exclusive, each with its rule's name (kind@version) and its place in UTF-8 bytes.
LEDGER = "blob string, rules array<string>, spans array<struct<start:int,end:int,rule:string,at:int,to:int>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, todo: Column, k: int, rule: Rule) -> Column:
    """The matches of one rule as (kind, i, gap before, length, both in bytes, long enough), in order."""
    sizes = lambda x: F.struct(F.length(x).alias("n"), F.octet_length(x).alias("b"))
    found = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), sizes).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), sizes).alias("len"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("got"),
    )
    rows = F.transform(
        F.filter(found, lambda x: x["len"].isNotNull()),  # the last gap has no match behind it
        lambda x, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), x["gap"]["n"].alias("gap"), x["len"]["n"].alias("len"), x["gap"]["b"].alias("bgap"), x["len"]["b"].alias("blen"), (x["got"] >= rule.least).alias("ok")
        ),
    )
    return F.when(F.array_contains(todo, rule.name) & text.rlike(rule.pattern), rows).otherwise(F.from_json(F.lit("[]"), _NONE))


def _names(rules: tuple[Rule, ...]) -> Column:
    return F.array(*[F.lit(r.name) for r in rules])


def unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger rows (see LEDGER) of the blobs in ``versions`` for rules that ``ledger`` lacks; nothing else is scanned.

    One row for each blob with unseen rules: blob, the rules now applied, their spans by start. ``versions``
    needs a column ``text``; others, whatever their names, are ignored. Null texts share the empty text's blob.
    Repeated texts are one blob. Texts of any length are scanned whole. An empty table gives no rows. A rule with
    a raised version reads every blob again, others don't. The text moves once, one copy a blob, combined
    before the shuffle, so a text that a third of all rows share is no hot key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    blobs = versions.select(blob_of(F.col("text")).alias("blob"), text.alias("text")).groupBy("blob").agg(F.any_value("text").alias("text"))
    if ledger is None:
        blobs = blobs.withColumn("todo", _names(rules))
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        todo = F.when(F.col("seen").isNull(), _names(rules)).otherwise(F.array_except(_names(rules), "seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0)
    each = F.flatten(F.array(*[_matches(F.col("text"), F.col("todo"), k, r) for k, r in enumerate(rules)]))
    rows = blobs.select("blob", "todo", F.explode_outer(each).alias("m")).select("blob", "todo", "m.*")
    w = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    whole = lambda c: F.col(c).cast("int")
    start, at = (whole("end") - F.col("len")).alias("start"), (whole("to") - F.col("blen")).alias("at")
    span = F.when(F.col("ok"), F.struct(start, whole("end").alias("end"), F.get(_names(rules), F.col("kind")).alias("rule"), at, whole("to").alias("to")))
    ends = {"end": F.sum(F.col("gap") + F.col("len")).over(w), "to": F.sum(F.col("bgap") + F.col("blen")).over(w)}
    fresh = rows.withColumns(ends).groupBy("blob").agg(F.any_value("todo").alias("rules"), F.sort_array(F.collect_list(span)).alias("spans"))
    return staged(fresh, "secret-ledger")


def scan_history(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger after a scan of ``versions``: its old rows and those of `unseen`."""
    fresh = unseen(versions, ledger, rules)
    return fresh if ledger is None else ledger.select("blob", "rules", "spans").unionByName(fresh)


def extend(path: str, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Append what ``versions`` adds to the ledger kept as Parquet at ``path`` (made where there is none); the whole ledger.

    Rows are only ever appended. Should two scans of the same blobs overlap, both append equal findings, which `current` shows once.
    """
    spark = versions.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    unseen(versions, spark.read.schema(LEDGER).parquet(path) if there else None, rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def current(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans (start, kind's place in ``rules``, end) that ``rules`` found, each once and in order; blobs without any are left out."""
    mine = F.filter("spans", lambda s: F.array_contains(_names(rules), s["rule"]))
    placed = F.transform(mine, lambda s: F.struct(s["start"].alias("start"), (F.array_position(_names(rules), s["rule"]) - 1).cast("int").alias("kind"), s["end"].alias("end")))
    rows = ledger.select("blob", placed.alias("spans")).filter(F.size("spans") > 0)
    each_once = lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1)))  # noqa: E731  linear, as array_distinct isn't for structs
    return rows.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")).select("blob", let(F.col("spans"), each_once).alias("spans"))


def masked(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans (start, kind, end): the stretches of bytes that ``rules`` found, in order, overlapping ones as one; kind is 0. For `redact`."""
    mine = F.filter("spans", lambda s: F.array_contains(_names(rules), s["rule"]))
    rows = ledger.select("blob", F.explode(mine).alias("s")).select("blob", "s.at", "s.to")
    w = Window.partitionBy("blob").orderBy("at", "to")
    before = F.max("to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", (F.coalesce(F.col("at") >= before, F.lit(True))).cast("int"))
    rows = rows.withColumn("nth", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("blob", "nth").agg(F.min("at").alias("start"), F.max("to").alias("end"))
    return rows.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", F.lit(0).alias("kind"), "end"))).alias("spans"))


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def _with_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (blob, ...) with the spans of their blobs, an empty list where there are none; a blob that many rows share is no task of its own."""
    nothing = F.from_json(F.lit("[]"), _SPANS)
    held = rows.groupBy("blob").agg(F.count("*").alias("n")).join(found.hint("merge"), "blob", "left").withColumn("spans", F.coalesce("spans", nothing))
    total = rows.count()
    held = held.filter((F.size("spans") > 0) | (F.col("n") * HOT > total))
    spread = F.concat(F.lit("/"), F.floor(F.rand(7) * 4096).cast("string"))  # no address has a slash; which task reads a row changes no result
    return hot_join(rows, held, "blob", "spans", total, spread).withColumn("spans", F.coalesce("spans", nothing))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of ``paths`` (with ``blob``) and what the ledger holds of ``rules`` for them; every path keeps its row.

    Adds n_<kind> for the base rules, base_sha256, spans (as text) and found (as structs); columns of ``paths`` with
    these names give way. A path without findings, or whose blob is null or unknown, has zeros and empty lists.
    """
    base = [k for k, r in enumerate(rules) if r.base]
    added = [*[f"n_{rules[k].kind}" for k in base], "base_sha256", "spans", "found"]
    mine = [c for c in paths.columns if c.lower() not in added]
    rows = _with_spans(paths.select(F.struct(*[F.col(f"`{c}`") for c in mine]).alias("path"), "blob"), current(ledger, rules))
    spans = F.col("spans")
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        *[F.col("path")[c].alias(c) for c in mine],
        *[of(k).alias(f"n_{rules[k].kind}") for k in base],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"].isin(base)), rules), 256).alias("base_sha256"),
        _joined(spans, rules).alias("spans"),
        spans.alias("found"),
    )


def scan_documents(docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row for each row of ``docs``, from an empty ledger.

    Null and empty texts have no findings. Rows without an id and rows that repeat an id or a text keep a row each.
    Texts of any length are read whole. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    paths = docs.select(F.col(id_col).alias("doc_id"), blob_of(F.col("text")).alias("blob"))
    return findings(paths, scan_history(docs.select("text"))).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; overlapping spans become one. n_chars follows the text.

    Other columns (of any names), rows without findings and null texts stay as they are. Repeated rows are treated alike;
    an empty table stays empty.
    """
    found = masked(scan_history(docs.select("text")))
    rows = _with_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), blob_of(F.col("text")).alias("blob")), found)
    none = F.size("spans") == 0

    # bytes are cut in one step each, code points only by counting from the text's start
    def cut(x: Column) -> Column:
        data, spans = x["data"], x["spans"]
        last = lambda i: F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
        kept = F.transform(spans, lambda s, i: F.substring(data, last(i) + 1, s["start"] - last(i)).cast("string"))
        end = last(F.size(spans))
        return F.array_join(F.concat(kept, F.array(F.substring(data, end + 1, F.length(data) - end).cast("string"))), mask)

    cut = let(F.struct(F.col("doc")["text"].cast("binary").alias("data"), "spans"), cut)
    rows = rows.withColumn("new", F.when(none, F.col("doc")["text"]).otherwise(cut))
    new = {"text": F.col("new"), "n_chars": F.when(none, F.col("doc")["n_chars"]).otherwise(F.length("new").cast("long"))} if "n_chars" in docs.columns else {"text": F.col("new")}
    return rows.select(*[(new[c] if c in new else F.col("doc")[c]).alias(c) for c in docs.columns])
