"""Document fingerprints: threshold-scaled sketches (DataFrame functions only).

A sketch keeps every hash of a five-word shingle below a fixed fraction of the hash range, so the
sketch of a union is the union of sketches and a short document can be held against a very long
one. Sketches of few shingles would be empty or nearly so; the LEAST smallest hashes are kept
in any case, which a merge preserves too. Two sketches are compared below the smaller of the
bounds up to which each is complete.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import let, partitions

WORDS = 5
FRACTION = 4  # one hash in so many is below the bound
LEAST = 32
_TOP = 2**63 - 1
#: Rows of a bucket, about, in which the next document is found; more rows of one id (or without one) than MANY are dealt to buckets of their own.
PER_BUCKET, MANY = 1 << 20, 1 << 14
_LOW = -(2**63)


def _shingles(text: Column) -> Column:
    """63-bit hashes of the shingles; a text of fewer words is one shingle, one without words none."""
    words = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")

    def rolled(h: Column) -> Column:
        five = F.transform(F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WORDS)]).bitwiseAND(_TOP))
        return F.when(F.size(h) >= WORDS, five).when(F.size(h) > 0, F.array(F.xxhash64(h).bitwiseAND(_TOP))).otherwise(F.expr("cast(array() as array<bigint>)"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), rolled)


def sketch(text: Column) -> Column:
    """array<long>: the retained hashes, ascending. Null counts as empty; an empty text has an empty sketch."""

    def kept(s: Column) -> Column:
        below = F.array_distinct(F.filter(s, lambda x: x <= _TOP // FRACTION))
        return let(below, lambda b: F.when(F.size(b) >= LEAST, F.array_sort(b)).otherwise(F.slice(F.array_sort(F.array_distinct(s)), 1, LEAST)))

    return let(_shingles(F.coalesce(text, F.lit(""))), kept)


def _complete_to(s: Column) -> Column:
    return F.when(F.size(s) < LEAST, F.lit(_TOP)).otherwise(F.greatest(F.lit(_TOP // FRACTION), F.element_at(s, -1)))


def compared(a: Column, b: Column) -> Column:
    """struct(jaccard, containment): estimates from two sketches; containment of the smaller set in the larger.

    Two empty sketches are alike (1.0); an empty one and another are not (0.0).
    """

    def counts(p: Column) -> Column:
        top = F.least(p["ta"], p["tb"])
        x, y = F.filter(p["a"], lambda v: v <= top), F.filter(p["b"], lambda v: v <= top)
        return F.struct(F.size(F.array_intersect(x, y)).alias("both"), F.size(x).alias("x"), F.size(y).alias("y"))

    def ratio(c: Column) -> Column:
        union, small = c["x"] + c["y"] - c["both"], F.least(c["x"], c["y"])
        return F.struct(
            F.when(union > 0, c["both"] / union).otherwise(F.lit(1.0)).cast("double").alias("jaccard"),
            F.when(small > 0, c["both"] / small).when(union > 0, F.lit(0.0)).otherwise(F.lit(1.0)).cast("double").alias("containment"),
        )

    pair = F.struct(a.alias("a"), b.alias("b"), _complete_to(a).alias("ta"), _complete_to(b).alias("tb"))
    return let(let(pair, counts), ratio)


def merged(a: Column, b: Column) -> Column:
    """The sketch of the union of two shingle sets."""
    return let(
        F.array_sort(F.array_union(a, b)),
        lambda u: let(F.size(F.filter(u, lambda x: x <= _TOP // FRACTION)), lambda n: F.slice(u, 1, F.greatest(n, F.lit(LEAST)))),
    )


def printed(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), ",")


def _cuts(rows: DataFrame, many: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Least keys (o, h) of the buckets, and the keys that more than ``many`` rows have.

    There are four buckets for a shuffle partition and one for PER_BUCKET rows, besides those that frequent ids take.
    """
    total = rows.count()
    n = 4 * partitions(rows.sparkSession) + total // PER_BUCKET
    got = rows.agg(F.percentile_approx("o", [i / n for i in range(n)], 10 * n).alias("q"), F.min("o").alias("first")).first()
    points = Counter([got["first"], *got["q"]] if total else [])
    often = {o: k for o, k in points.items() if k > 1 and (k - 1) * total > n * many}
    cuts, hot = {(o, _LOW) for o in points if o not in often}, []
    if often:
        mine = rows.filter(F.col("o").isin(*often))
        hot = [(r["o"], r["h"]) for r in mine.groupBy("o", "h").count().filter(F.col("count") > many).collect()]  # total / many at most
        # h is a hash: equal ranges of it take equal shares of an id's different texts. The cuts are keys that exist
        pieces = F.create_map(*[F.lit(x) for pair in often.items() for x in pair])[F.col("o")]
        nth = F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * pieces)
        cuts |= {(r["o"], r["h"]) for r in mine.groupBy("o", nth).agg(F.min("h").alias("h")).collect()}
    return sorted(cuts), hot


def with_next(docs: DataFrame, then, many: int = MANY) -> DataFrame:
    """Rows in the order of doc_id (nulls last, ties by the text's hash, then the text) with the text of the row behind, the first behind the last.

    One shuffle of the text and no task that grows with the table: quantiles of the ids cut the order into buckets, more of them
    for more rows. An id that many rows have, or none, is cut further by the texts' hashes; equal rows beyond ``many`` are
    counted before the shuffle: the last one keeps its place, the others, each followed by its like, travel in pieces to any
    bucket. The first row of each bucket is copied to the bucket before it, where it ends the run. ``then`` maps the frame
    (doc_id, text, next_text, alone, times) and may use ``lead`` over the returned window without a further shuffle, but for rows that are ``alone``.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_TOP)).alias("o"), F.xxhash64(text).alias("h"), text.alias("text"))
    cuts, hot = _cuts(rows, many)
    rows = rows.withColumns({"alone": F.lit(0).cast("long"), "times": F.lit(1).cast("long")})
    if hot:
        keys = F.broadcast(spark.createDataFrame(hot, "o long, h long"))
        once = rows.join(keys, ["o", "h"], "left_semi").groupBy("doc_id", "o", "h", "text").agg(F.count("*").alias("n"))
        piece = F.explode(F.sequence(F.lit(0), F.ceil((F.col("n") - 1) / many).cast("long"))).alias("alone")  # 0: the row that keeps its place
        once = once.select("doc_id", "o", "h", "text", piece, "n").withColumn("times", F.when(F.col("alone") == 0, 1).otherwise(F.least(F.lit(many), F.col("n") - 1 - (F.col("alone") - 1) * many)))
        rows = rows.join(keys, ["o", "h"], "left_anti").unionByName(once.drop("n"))
    size = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + size] for i in range(0, len(cuts), size)] or [[(0, 0)]]
    show = lambda keys: [{"o": o, "h": h} for o, h in keys]
    # one literal each, however many cuts there are
    tops = F.from_json(F.lit(json.dumps(show([b[0] for b in blocks]))), "array<struct<o:bigint,h:bigint>>")
    lists = F.from_json(F.lit(json.dumps([show(b) for b in blocks])), "array<array<struct<o:bigint,h:bigint>>>")
    below = lambda t: (t["o"] < F.col("o")) | ((t["o"] == F.col("o")) & (t["h"] <= F.col("h")))
    rows = rows.withColumn("j", F.size(F.filter(tops, below)) - 1)
    rows = rows.withColumn("c", F.filter(F.get(lists, F.col("j")), below))
    rows = rows.withColumn("bucket", F.when(F.col("alone") > 0, 1 + F.pmod(F.xxhash64("h", "alone"), F.lit(max(1, len(cuts))))).otherwise(F.col("j") * size + F.size("c")))
    last = F.element_at("c", -1)
    starts = (F.col("alone") == 0) & (last["o"] == F.col("o")) & ((last["h"] == F.col("h")) | (last["h"] == _LOW))
    place = lambda b, wrap, ghost: F.struct(b.cast("long").alias("bucket"), F.lit(wrap).alias("wrap"), F.lit(ghost).alias("ghost"))
    own = place(F.col("bucket"), False, False)
    places = (
        F.when(starts & (F.col("bucket") > 1), F.array(own, place(F.col("bucket") - 1, False, True)))
        .when(starts, F.array(own, place(F.lit(len(cuts)), True, True)))
        .otherwise(F.array(own))
    )
    rows = rows.select("doc_id", "o", "h", "text", "alone", "times", F.inline(places))
    w = Window.partitionBy("bucket").orderBy(F.col("alone") > 0, "wrap", "o", "h", "ghost", "text")
    after = F.when(F.col("alone") > 0, F.col("text")).otherwise(F.coalesce(F.lead("text").over(w), F.lit("")))
    return then(rows.withColumn("next_text", after), w).filter(~F.col("ghost"))


def fingerprint_documents(docs: DataFrame, many: int = MANY) -> DataFrame:
    """One row for each row of ``docs``: the contract's columns and the containment estimates.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of the
    next document's. A null text is empty. With one document the next is itself. Rows without an id come last; of rows with one id
    the text's hash decides which is next, and of equal rows one is followed by the next document, the others by their like.
    Texts of any length are read whole. An empty table gives no rows; other columns, whatever their names, are ignored.
    """

    def prints(rows: DataFrame, w) -> DataFrame:
        n = F.length("text")
        edited = F.concat(F.expr("substring(text, 1, length(text) - length(text) div 2)"), F.expr("substring(next_text, 1, cast(length(text) div 2 as int))"))
        place = ["bucket", "alone", "wrap", "o", "h", "ghost"]
        rows = rows.select("doc_id", *place, "times", "text", n.cast("long").alias("n_chars"), sketch(F.col("text")).alias("s"), edited.alias("edited"))
        rows = rows.withColumn("s_next", F.when(F.col("alone") > 0, F.col("s")).otherwise(F.lead("s").over(w)))
        return rows.select("*", sketch(F.col("edited")).alias("s_edited"))

    rows = with_next(docs, prints, many)
    rows = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("s")).alias("fingerprint"), printed(F.col("s_edited")).alias("edited_fingerprint"),
        compared(F.col("s"), F.col("s_edited")).alias("e"), compared(F.col("s"), F.col("s_next")).alias("x"), "times",
    ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.col("e.jaccard").alias("near_edited"), F.col("x.jaccard").alias("near_next"),
        F.col("e.containment").alias("contained_edited"), F.col("x.containment").alias("contained_next"),
    )
