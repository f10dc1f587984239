"""MinHash near-duplicate detection with fast similarity sketches.

After Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching" (FOCS 2017): see
`kernels.similarity_sketch`. Sketches are cut into bands; documents that share a band are
candidates; links are confirmed on the full shingle sets. With 48 bands of 6 coordinates a pair of
similarity 0.8 shares no band with a chance of 5e-7.

Documents of one set are one class and take part once. A band's bucket isn't expanded into pairs. Its
centre, the member that meets most others in all its buckets, is held against every member, and
components follow from these links. A link that could still join two components has an end
apart from its bucket's centre. Both ends are known by what they differ in from the centre, and sets this much alike must
share a large part of these differences: a prefix join over the differences finds the rest of the
candidates, exactly. It joins the components that share a difference before their members, so members of one
component never meet, however many hang on a foreign centre.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .base import HOT, hot_join, small_batches, staged
from .components import components

BANDS, ROWS = 48, 6


def _signed(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = kernels.mix(np.arange(bands, dtype=np.uint64), 77)
        for batch in batches:
            for flat in kernels.chunks(batch.column("text")):
                h, first = kernels.words(flat)
                sets, bounds = kernels.distinct(*kernels.shingles(h, first, k))
                n = np.diff(bounds)
                keys = kernels.mix(kernels.band_keys(kernels.similarity_sketch(sets, bounds, bands * rows), bands, rows) ^ seeds)
                signs = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(bounds[:-1], bounds[1:])]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)), pa.array(keys[n > 0].ravel().view(np.int64))
                )
                ids = batch.column("doc_id").slice(flat.first, len(flat))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(signs, pa.binary()), lists], ["doc_id", "n", "sign", "keys"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for flat in kernels.chunks(batch.column("text")):
                h, first = kernels.words(flat)
                sets, bounds = kernels.distinct(*kernels.shingles(h, first, k))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(flat.first, len(flat)), lists], ["id", "set"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, delta: bool = False) -> DataFrame:
    """a, b, both, na, nb for every pair: the sizes of the full sets and of their intersection; ``delta``: what b and not a has, then what a and not b has.

    A hot centre's set is copied once for each 1 in HOT of all pairs that it has, and its pairs are dealt to the copies.
    """
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    total = pairs.count()
    hot = F.broadcast(many.filter(F.col("n") * HOT > total).select("a", F.ceil(F.col("n") * HOT / max(1, total)).cast("int").alias("copies")))  # fewer than HOT rows, 2 * HOT copies
    copies = F.coalesce("copies", F.lit(1))
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("sa")).join(hot, "a", "left").select("a", "sa", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    dealt = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), copies).cast("int").alias("copy"))
    both = F.size(F.array_intersect("sa", "sb")).alias("both")
    rows = dealt.join(right, "b").join(left, ["a", "copy"]).select("a", "b", both, F.size("sa").alias("na"), F.size("sb").alias("nb"), *([F.concat(F.array_except("sb", "sa"), F.array_except("sa", "sb")).alias("delta")] * delta))
    return staged(rows, "near-verified")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, *, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text; others are ignored).

    Words are runs of other than white space, A-Z lower-cased. A set holds the distinct k-word
    shingles; of fewer words the whole sequence is one; without words or text it is empty and linked
    with nothing. Two documents are linked if 100 * |both| >= percent * |either|. Rows that repeat an id are one
    document of the graph. component_id: the smallest id reachable, which settles ties. Rows without an id get the component of an
    equal set that has one, else none, and are never kept. Texts of any length are read whole; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signs = staged(docs.mapInArrow(_signed(k, bands, rows), "doc_id long, n long, sign binary, keys array<long>"), "near-signs")
    classes = staged(
        signs.filter("sign is not null and doc_id is not null").groupBy("sign").agg(F.min("doc_id").alias("rep"), F.any_value("keys").alias("keys"), F.count("*").alias("n")), "near-classes"
    )
    held = classes.select("rep", F.explode("keys").alias("key"))
    full = held.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    # a band's value that very many sets have is in many tasks
    total = bands * classes.count()
    members = staged(hot_join(held, full.withColumn("n", F.col("m")), "key", "m", total, F.xxhash64("rep")).filter("m is not null"), "near-members")
    weight = members.groupBy("rep").agg(F.sum("m").alias("w"))
    centre = members.join(weight, "rep").groupBy("key").agg(F.max(F.struct("w", -F.col("rep"))).alias("c"), F.count("*").alias("n")).select("key", (-F.col("c")["col2"]).alias("a"), "n")
    pairs = staged(hot_join(members, centre, "key", "a", total, F.xxhash64("rep")).filter("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "near-pairs")

    need = weight.select(F.col("rep").alias("doc_id"))
    sets = staged(docs.join(need.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(k), "id long, set array<long>"), "near-sets")
    same = f"100 * both >= {percent} * (na + nb - both)"
    done = _verified(pairs, sets, True)
    links = done.filter(same).select("a", "b")
    comp = staged(components(links), "near-components")
    more = _verified(staged(_across(done, comp, percent), "near-pairs"), sets).filter(same).select("a", "b")
    if not more.isEmpty():
        comp = staged(components(links.union(more)), "near-components")
    found = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("sign", F.coalesce("component", "rep").alias("component"), "n")
    rows = hot_join(signs.select("doc_id", F.col("n").alias("n_shingles"), "sign"), found, "sign", "component", classes.agg(F.sum("n")).first()[0] or 0, F.xxhash64("doc_id").cast("string").cast("binary"))
    comp_of_id = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", comp_of_id.alias("component_id"), F.coalesce(F.col("doc_id") == comp_of_id, F.lit(False)).alias("kept"))


def _across(done: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet at a centre and may be linked, one of them at least apart from the centre.

    With x, y as differences from the centre, |x ^ y| = |x| + |y| - 2 |x & y|, and a link needs |x ^ y| <= r (nx + ny), r = (100 - percent) /
    (100 + percent). So |x & y| >= (|x| + |y| - r (nx + ny)) / 2 = need, and a shared element stands among the first |x| - need + 1 of x and
    of y alike, in any order common to both. Elements that the centre lacks come first: edits seldom agree in these.
    """
    r = (100 - percent) / (100 + percent)
    own = comp.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    total = done.count()
    at = done.groupBy("a").agg(F.count("*").alias("n")).join(comp.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
    rows = hot_join(done.join(own, "b", "left"), at, "a", "ca", total, F.xxhash64("b"))
    rows = rows.select("a", F.col("b").alias("v"), F.col("na"), F.col("nb").alias("n"), F.coalesce("cb", "b").alias("c"), (F.coalesce("cb", "b") != F.coalesce("ca", "a")).alias("apart"), "delta", F.size("delta").alias("d"))
    rows = staged(rows, "near-apart")
    some, ys, test = _meetings(rows, total, percent)
    found = some.join(ys, ["a", "e", "cy"]).filter(test)
    pairs = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs.join(done.select("a", "b").union(done.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti")


def _meetings(rows: DataFrame, total: int, percent: int) -> tuple[DataFrame, DataFrame, str]:
    """Members (a, e, cy, x, ...) that may meet one of a foreign component in a shared difference; those components' members; the test of a pair of both.

    ``rows``: a, v, na, n, c, apart, delta, d as `_across` makes them, ``total`` of them.
    """
    r = (100 - percent) / (100 + percent)
    open_ = rows.groupBy("a").agg(F.max("apart").alias("open"), F.count("*").alias("n")).filter("open")
    # the partner is apart: its own difference exceeds r (n + na)
    x = hot_join(rows.withColumnRenamed("n", "nv"), open_, "a", "open", total, F.xxhash64("v")).filter("open").withColumnRenamed("nv", "n").withColumn("last", F.expr(f"cast(d - greatest(1, ceil((d + {r} * (na - n)) / 2 - 1e-6)) + 1 as int)"))
    y = rows.filter("apart").withColumn("last", F.expr(f"cast(d - greatest(1, ceil((d - {r} * n * (1 + 100 / {percent})) / 2 - 1e-6)) + 1 as int)"))

    def entries(t: DataFrame, tag: str) -> DataFrame:
        return t.filter("last > 0").select("a", F.col("v").alias(tag), F.col("n").alias("n" + tag), F.col("c").alias("c" + tag), F.col("d").alias("d" + tag), F.posexplode(F.slice("delta", 1, F.col("last"))).alias("p" + tag, "e"))

    need = f"ceil((dx + dy - {r} * (nx + ny)) / 2 - 1e-6)"
    xs, ys = entries(x, "x"), entries(y, "y")
    # a component's bounds stand for its members first: what x may meet there must pass the same tests with the least need and the latest place
    meet = ys.groupBy("a", "e", "cy").agg(F.min(F.expr(f"dy - {r} * ny")).alias("w"), F.max(F.expr(f"dy / 2 - py + {r} * ny / 2")).alias("z"))
    some = xs.join(meet, ["a", "e"]).filter(f"cx <> cy and px < dx - ceil((dx - {r} * nx + w) / 2 - 1e-6) + 1 and (dx - {r} * nx) / 2 < 1 + z + 1e-6")
    return some.drop("w", "z"), ys, f"px < dx - {need} + 1 and py < dy - {need} + 1 and least(dx, dy) >= {need}"
