"""Deterministic fact extraction with provenance, corroboration and the wire guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.ids import fact_id
from ..functions.text import NOT_WS, WS, collapsed, gram_keys, gram_words, let, word_count, word_grams
from ..plans.staging import staged
from ..functions.urls import etld1

_B, _E = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
ORGS = f"(?i){_B}({'|'.join(V.ORGANISATIONS)}){_E}"
NAMES = f"{_B}([A-Z][a-z]+(?:{WS}+[A-Z][a-z]+){{0,3}}){_E}"
# A unit must end at a word's bound: '%' and '×' count only before a word character.
_WORDS = [u for u in V.UNITS if u.isascii() and u.isalpha()]
_SIGNS = "".join(u for u in V.UNITS if u not in _WORDS)
NUMBERS = rf"(?i){_B}[0-9][0-9,.]*{WS}*(?:(?:{'|'.join(_WORDS)}){_E}|[{_SIGNS}](?=[A-Za-z0-9_]))"
#: Rows and bits (8 MB) of a Bloom filter, at most.
PARTS, MOST_BITS = 64, 1 << 26


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def sentences(body: Column) -> Column:
    """Sentences of 31 to 499 characters, the first twenty."""
    return F.slice(F.filter(F.split(body, rf"(?<=[.!?]){WS}+"), lambda s: (F.length(s) > 30) & (F.length(s) < 500)), 1, 20)


def facts(docs: DataFrame) -> DataFrame:
    """Up to eight facts of each row (topic, cluster_id, doc_id, source_domain, url, body), statements distinct within it. Nothing is shuffled."""
    item = lambda x, *names, **more: F.struct(*[x[n].alias(n) for n in names], *[v.alias(k) for k, v in more.items()])

    def found(x: Column) -> Column:
        other = lambda low: F.filter(x["caps"], lambda e: (F.length(e) > 3) & ~e.isin(*V.NO_NAMES) & ~F.array_contains(low, F.lower(e)))
        return F.concat(x["orgs"], let(F.transform(x["orgs"], F.lower), other))

    def statement(x: Column) -> Column:
        words = F.split(F.regexp_replace(F.lower(x["s"]), r"[^a-z0-9\t\n\x0B\f\r ]", " "), r"[\t\n\x0B\f\r ]+")
        words = F.slice(F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*V.STATEMENT_STOPWORDS)), 1, 6)
        return F.substring(collapsed(F.concat_ws(" ", x["primary"], F.array_join(words, " "))), 1, 120)

    def first_of_each(rows: Column) -> Column:
        return let(F.transform(rows, lambda x: F.lower(x["statement"])), lambda keys: F.filter(rows, lambda x, i: F.array_position(keys, F.lower(x["statement"])) == i + 1))

    rows = F.transform(sentences(F.col("body")), lambda s: F.struct(s.alias("s"), _all(s, ORGS).alias("orgs"), _all(s, NAMES).alias("caps"), _all(s, NUMBERS).alias("numbers")))
    rows = F.filter(F.transform(rows, lambda x: item(x, "s", "numbers", found=found(x))), lambda x: (F.size(x["found"]) > 0) | (F.size(x["numbers"]) > 0))
    rows = F.transform(rows, lambda x: item(x, "s", "numbers", "found", primary=F.coalesce(F.get(x["found"], F.lit(0)), F.col("topic"))))
    rows = F.slice(let(F.transform(rows, lambda x: item(x, "s", "numbers", "found", "primary", statement=statement(x))), first_of_each), 1, 8)
    rows = docs.select("topic", "cluster_id", "doc_id", "source_domain", "url", F.posexplode(rows).alias("pos", "x")).select("*", "x.*").drop("x")
    quoted = _all(F.col("s"), f"{NOT_WS}+")
    quote = F.concat(F.array_join(F.slice(quoted, 1, 20), " "), F.when(F.size(quoted) > 20, "…").otherwise(""))
    value = F.expr(r"try_cast(regexp_extract(regexp_replace(get(numbers, 0), '[^0-9.]', ''), '^[0-9]*[.]?[0-9]+', 0) as double)")
    return rows.select(
        fact_id(F.col("cluster_id"), F.col("statement"), F.col("doc_id")).alias("id"), "topic", "cluster_id", "doc_id", "source_domain", "url", (F.col("pos") + 1).alias("nth"), "statement",
        F.slice(F.array_distinct("found"), 1, 8).alias("entities"), quote.alias("quote"), F.when(value.isNotNull(), F.col("primary")).alias("metric"), value.alias("value"),
    )


def corroborated(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds corroboration (distinct owners over the cluster's documents, 1 at least) and confidence."""
    owners = docs.groupBy("cluster_id").agg(F.countDistinct(etld1(F.col("source_domain"))).alias("n"))
    n = F.greatest(F.coalesce("n", F.lit(1)), F.lit(1)).cast("long")
    sure = F.when(F.col("confidence") == "high", "high").otherwise("medium") if "confidence" in found.columns else F.lit("medium")
    return found.join(owners, "cluster_id", "left").withColumn("corroboration", n).withColumn("confidence", F.when(n >= 2, sure).otherwise("low")).drop("n")


RAW = "array<struct<statement: string, quote: string, entities: array<string>, confidence: string, quantity: struct<metric: string, value: double>>>"


def provided(landed: DataFrame, docs: DataFrame) -> DataFrame:
    """Facts that another extractor landed (landed: cluster_id, doc_id, raw: JSON {"facts": [...]}), joined to the documents they name.

    Unreadable JSON, statements of fewer than 10 characters and such that share eight words with the document are passed over; a quote over the limit
    is left out, an unknown confidence is medium. Columns as those of `facts`, and confidence.
    """
    read = F.from_json("raw", f"facts {RAW}")["facts"]
    rows = landed.select("cluster_id", "doc_id", F.posexplode(read).alias("pos", "f")).join(docs.select("topic", "cluster_id", "doc_id", "source_domain", "url", "body"), ["cluster_id", "doc_id"])
    rows = rows.filter((F.length("f.statement") >= 10) & ~overlaps(F.col("f.statement"), F.col("body")))
    confidence = F.when(F.col("f.confidence").isin("high", "low"), F.col("f.confidence")).otherwise("medium")
    both = F.col("f.quantity.metric").isNotNull() & F.col("f.quantity.value").isNotNull()
    return rows.select(
        fact_id(F.col("cluster_id"), F.col("f.statement"), F.col("doc_id")).alias("id"), "topic", "cluster_id", "doc_id", "source_domain", "url", (F.col("pos") + 1).alias("nth"), F.col("f.statement").alias("statement"),
        F.filter(F.coalesce("f.entities", F.array().cast("array<string>")), lambda e: e != "").alias("entities"), F.when(word_count(F.col("f.quote")) <= V.QUOTE_WORDS, F.col("f.quote")).alias("quote"),
        F.when(both, F.col("f.quantity.metric")).alias("metric"), F.when(both, F.col("f.quantity.value")).alias("value"), confidence.alias("confidence"),
    )


def chosen(docs: DataFrame, landed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Facts of each cluster by the landed extractor, or, where it gave none, by rules; and topic, cluster_id, reason of the clusters that fell back."""
    ruled = facts(docs).withColumn("confidence", F.lit("low"))
    clusters = docs.select("topic", "cluster_id").distinct()
    if landed is None:
        return ruled, clusters.withColumn("reason", F.lit("extractor unavailable: facts by rules"))
    own = staged(provided(landed, docs), "facts-provided")
    named = own.select("cluster_id").distinct()
    tried = landed.select("cluster_id").distinct().withColumn("tried", F.lit(True))
    reason = F.when(F.col("tried"), "extractor returned no facts: facts by rules").otherwise("extractor unavailable: facts by rules")
    fallen = clusters.join(named, "cluster_id", "left_anti").join(tried, "cluster_id", "left").select("topic", "cluster_id", reason.alias("reason"))
    return own.unionByName(ruled.join(named, "cluster_id", "left_anti")), fallen


def valid(found: DataFrame) -> DataFrame:
    """Adds schema_ok: whether a fact has what the public schema asks for (id, topic, cluster, statement of 1 to 500 characters, corroboration of 1 or more, a known confidence)."""
    ok = F.col("id").rlike("^[0-9a-f]{32}$") & (F.coalesce("topic", F.lit("")) != "") & (F.coalesce("cluster_id", F.lit("")) != "") & F.length("statement").between(1, 500)
    ok = ok & (F.col("corroboration") >= 1) & F.col("confidence").isin("high", "medium", "low") & (F.col("metric").isNull() == F.col("value").isNull())
    return found.withColumn("schema_ok", F.coalesce(ok, F.lit(False)))


def checked_quote(quote: Column, limit: int = V.QUOTE_WORDS) -> Column:
    """The quote; one over the limit fails the job."""
    message = F.concat(F.lit("quote too long: "), F.substring(quote, 1, 80))
    return F.when(F.coalesce(word_count(quote), F.lit(0)) <= limit, quote).otherwise(F.raise_error(message).cast("string"))


def _mask(b: Column) -> Column:
    """A key's three bits of a 64-bit word."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(b, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))


def bloom(keys: DataFrame, count: int) -> tuple[DataFrame, int]:
    """A Bloom filter of keys (a, b) as PARTS rows (part, words), and its words a part: some 16 bits a key, MOST_BITS at most, three of them set in one word each."""
    words = max(1, min(MOST_BITS, 1 << (16 * count).bit_length()) // 64 // PARTS)
    set_ = keys.groupBy(F.pmod("a", F.lit(PARTS)).cast("int").alias("part"), word_of(F.col("a"), words).alias("word")).agg(F.bit_or(_mask(F.col("b"))).alias("bits"))
    id_ = F.col("id")
    grid = keys.sparkSession.range(PARTS * words).select(F.pmod(id_, F.lit(PARTS)).cast("int").alias("part"), F.shiftright(id_, PARTS.bit_length() - 1).cast("int").alias("word"))
    cells = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return grid.join(set_, ["part", "word"], "left").groupBy("part").agg(F.transform(cells, lambda c: c["bits"]).alias("words")), words


def word_of(a: Column, words: int) -> Column:
    return F.pmod(F.shiftrightunsigned(a, 8), F.lit(words)).cast("int")


def verbatim(statements: DataFrame, bodies: DataFrame, n: int = V.GRAM_WORDS) -> DataFrame:
    """Ids of statements (id, text) that share an n-gram of words with any body (text).

    Only 128-bit keys of the grams travel. A Bloom filter of the bodies' distinct keys, bounded in size, meets the statements' grams in the
    task that reads them; what it lets pass is joined to the keys themselves. A filter that is too small for its keys lets more pass, and loses nothing.
    Time is linear in the texts' lengths: no gram is compared with others of its text.
    """
    each = lambda df, *more: df.select(*more, F.explode(gram_keys(F.col("text"), n)).alias("gram")).select(*more, "gram.a", "gram.b")
    theirs = staged(each(bodies).distinct(), "gram-keys")
    filter_, words = bloom(theirs, theirs.count())
    mine = each(statements, "id").withColumn("part", F.pmod("a", F.lit(PARTS)).cast("int")).join(F.broadcast(filter_), "part")
    passed = mine.filter(F.get("words", word_of(F.col("a"), words)).bitwiseAND(_mask(F.col("b"))) == _mask(F.col("b")))
    passed = staged(passed.select("id", "a", "b").distinct(), "grams-passed")  # else the semi-join would be pushed below the filter, and meet every gram
    return passed.join(theirs.hint("merge"), ["a", "b"], "left_semi").select("id").distinct()


def overlaps(statement: Column, body: Column, n: int = V.GRAM_WORDS) -> Column:
    """Whether a statement shares n words in a row with one body; the grams are strings, which are sought by hash."""
    return F.coalesce(F.arrays_overlap(word_grams(statement, n), word_grams(body, n)), F.lit(False))


def guarded(found: DataFrame) -> DataFrame:
    """Adds violation, the first of: schema, provenance, verbatim, url, quote; null for clean facts. Needs provenance_count, url, quote, verbatim; schema_ok if there."""
    shaped = F.col("schema_ok") if "schema_ok" in found.columns else F.lit(True)
    return found.withColumn(
        "violation",
        F.when(~shaped, "schema")
        .when(F.coalesce("provenance_count", F.lit(0)) < 1, "provenance")
        .when(F.coalesce("verbatim", F.lit(False)), "verbatim")
        .when(F.coalesce(F.trim("url"), F.lit("")) == "", "url")
        .when(word_count(F.coalesce("quote", F.lit(""))) > V.QUOTE_WORDS, "quote"),
    )


__all__ = ["facts", "provided", "chosen", "valid", "checked_quote", "corroborated", "verbatim", "overlaps", "guarded", "sentences", "gram_words"]
