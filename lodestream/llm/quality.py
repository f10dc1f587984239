"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

An interpolated modified Kneser-Ney model of character n-grams is trained on every trusted document. Its counts are sharded tables,
and per-document perplexity comes from joins to them: the documents' n-grams, distinct within a block of documents, are dealt to
shards by their hash, where they meet the probabilities, and those return to the blocks. A document is scored by the
model that its own text had no part in (see `ngrams`), so trusted documents are judged like any other.

A document is kept if its perplexity lies in the range that trusted documents of its language and length take,
widened by a margin; text that is far less or (endless repeats) far more predictable goes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ngrams
from .base import partitions, small_batches, staged
from .ngrams import ORDER

#: Quantiles of trusted documents' mean nats a character, and the margin: so many times the way from the median.
LOW, HIGH, MARGIN = 0.005, 0.995, 0.5
#: Trusted documents that a language's length class needs for bounds of its own; else the language's, else all documents'.
ENOUGH = 30
#: Bits of the map of trusted ids' hashes by which blocks are packed; it spares untrusted text a shuffle and decides nothing.
BITS = 1 << 20
#: The least probability of the model, before discounted counts: all code points are equally likely.
UNIFORM = 1 / 0x110000


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """model, gram, n of the trusted documents (their places: ``some``) of each block; a text trains the models of the other folds."""
    for batch in batches:
        for packed, lens, some in zip(*(batch.column(c) for c in ("packed", "lens", "some"))):
            texts, seen, n = ngrams.unpack(packed.as_py(), lens.as_py()), ngrams.Known(), np.zeros(0, np.int64)
            for _, piece in ngrams.pieces([texts[i] for i in some.as_py()]):
                for k in range(1, ngrams.FOLDS):
                    numbers = seen.add(ngrams.Grams(piece, [(ngrams.fold(t) + k) % ngrams.FOLDS for t in piece]))
                    n = np.pad(n, (0, len(seen.keys) - len(n))) + np.bincount(numbers, minlength=len(seen.keys))
            yield pa.RecordBatch.from_arrays([pa.array(seen.models, pa.int32()), pa.array(ngrams.strings(seen.chars), pa.string()), pa.array(n, pa.int64())], ["model", "gram", "n"])


def _asked(shards: int):
    """block, shard, grams: what each block asks of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed, lens in zip(*(batch.column(c) for c in ("block", "packed", "lens"))):
                known = ngrams.known(ngrams.unpack(packed.as_py(), lens.as_py()))
                shard, order = ngrams.asked(known, shards)
                models, chars = known.models[order], known.chars[order]
                at = np.searchsorted(shard, np.arange(shards + 1))
                some = [s for s in range(shards) if at[s] < at[s + 1]]
                data = [ngrams.written(models[at[s] : at[s + 1]], chars[at[s] : at[s + 1]]) for s in some]
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array(data, pa.binary())], ["block", "shard", "grams"])

    return run


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, model, gram: the distinct n-grams of the questions, which come by shard."""
    kinds = [pa.int32(), pa.int32(), pa.string()]

    def rows(shard: int, seen: set) -> pa.RecordBatch:
        models, grams = [m for m, _ in seen], [g for _, g in seen]
        return pa.RecordBatch.from_arrays([pa.array([shard] * len(grams), kinds[0]), pa.array(models, kinds[1]), pa.array(grams, kinds[2])], ["shard", "model", "gram"])

    now, seen = -1, set()
    for batch in batches:
        for shard, data in zip(batch.column("shard").to_pylist(), batch.column("grams")):
            if shard != now:
                if seen:
                    yield rows(now, seen)
                now, seen = shard, set()
            models, chars = ngrams.read(data.as_py())
            seen.update(zip(models.tolist(), ngrams.strings(chars)))
    if seen:
        yield rows(now, seen)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, shard, nats: the answers in the order of each question; a shard's probabilities come before its questions."""
    now, held, keys, nats = -1, [], None, None
    names = ["block", "shard", "nats"]
    for batch in batches:
        out = []
        for shard, model, gram, p, block, data in zip(*(batch.column(c) for c in ("shard", "model", "gram", "p", "block", "grams"))):
            if shard.as_py() != now:
                now, held, keys = shard.as_py(), [], None
            if not block.is_valid:
                held.append((model.as_py(), gram.as_py(), p.as_py()))
                continue
            if keys is None:
                keys = ngrams.keys_of(ngrams.points_of("".join(g for _, g, _ in held)), np.array([m for m, _, _ in held]))
                order = np.argsort(keys)
                keys, nats, held = keys[order], -np.log(np.array([x for _, _, x in held]))[order].astype(np.float32), []
            models, chars = ngrams.read(data.as_py())
            out.append((block.as_py(), now, nats[np.searchsorted(keys, ngrams.keys_of(chars, models))].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 3, (pa.int64(), pa.int32(), pa.binary()))], names)


def _summed(shards: int):
    """doc_id, lang, size, nats: each document's mean nats a character, its closing mark counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, lens, ids, langs, sizes, answers in zip(*(batch.column(c) for c in ("packed", "lens", "ids", "langs", "sizes", "answers"))):
                pieces: list[tuple] = []
                known = ngrams.known(ngrams.unpack(packed.as_py(), lens.as_py()), pieces)
                _, order = ngrams.asked(known, shards)
                nats = np.zeros(len(known.keys))
                if len(order):
                    nats[order] = np.concatenate([np.frombuffer(x["nats"], np.float32) for x in sorted(answers.as_py(), key=lambda x: x["shard"])])
                total, count = np.zeros((2, len(lens)))
                for first, n, each, numbers in pieces:
                    total[first : first + n], count[first : first + n] = np.bincount(np.repeat(np.arange(n), each), nats[numbers], n), each
                mean = pa.array(total / np.maximum(count, 1), pa.float64(), mask=count == 0)
                yield pa.RecordBatch.from_arrays([ids.values, langs.values, sizes.values, mean], ["doc_id", "lang", "size", "nats"])

    return run


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney's discounts for counts of 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (float(x or 0) for x in counts.agg(*[F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)]).first())
    if not (n1 and n2 and n3):
        return [0.0, 0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0.0, *[min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw[1:])]]


def model(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """From (model, gram, n) of order ORDER: for each order from 1 on (model, gram, part) and (model, context, gap).

    part: the discounted share of an n-gram in its context; gap: the mass that the context leaves to the lower order. Lower orders count
    the different characters that precede an n-gram.
    """
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(ORDER, 0, -1):
        counts = staged(counts, f"kn-{k}")
        d = discounts(counts)
        off = F.element_at(F.array(*[F.lit(x) for x in d]), F.least(F.col("n"), F.lit(3)).cast("int") + 1)
        rows = counts.select("model", "gram", "n", F.substring("gram", 1, k - 1).alias("context"), off.alias("off"))
        totals = rows.groupBy("model", "context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("gap"))
        part = rows.join(totals, ["model", "context"]).select("model", "gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("part"))
        out.insert(0, (staged(part, f"kn-part-{k}"), staged(totals.select("model", "context", "gap"), f"kn-gap-{k}")))
        counts = counts.groupBy("model", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count("*").alias("n"))
    return out


def probabilities(wanted: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``wanted`` (model, gram: distinct; of as many characters as there are ``levels``) with p, the interpolated probability of the last character behind the others.

    A key of each join has no more rows than there are different characters, so none is hot.
    """
    if not levels:
        return wanted.withColumn("p", F.lit(UNIFORM))
    k = len(levels)
    part, gap = levels[-1]
    lower = probabilities(wanted.select("model", F.substring("gram", 2, k - 1).alias("gram")).distinct(), levels[:-1])
    lower = lower.select("model", F.col("gram").alias("rest"), F.col("p").alias("lower"))
    rows = wanted.join(part, ["model", "gram"], "left").withColumns({"context": F.substring("gram", 1, k - 1), "rest": F.substring("gram", 2, k - 1)})
    rows = rows.join(gap, ["model", "context"], "left").join(lower, ["model", "rest"])
    p = F.coalesce("part", F.lit(0.0)) + F.coalesce("gap", F.lit(1.0)) * F.col("lower")
    return rows.withColumn("p", p).drop("part", "gap", "context", "rest", "lower")


def scored(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, lang, size, nats of each row of ``docs`` (doc_id, text, lang) under the models trained on the rows whose id is in ``trusted`` (doc_id, distinct)."""
    spark = docs.sparkSession
    small_batches(spark)
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    bits = np.zeros(BITS, bool)
    bits[[r[0] for r in trusted.select(mark).distinct().toLocalIterator()]] = True  # BITS rows at most
    rows = docs.select("doc_id", "text", "lang", F.length(F.coalesce("text", F.lit(""))).alias("size"), F.when(F.col("doc_id").isNotNull(), mark).alias("mark"))
    blocks = staged(rows.mapInArrow(ngrams.pack(spark.sparkContext.broadcast(np.packbits(bits)), BITS), ngrams.BLOCKS), "quality-blocks")
    places = blocks.filter("marked").select("block", F.posexplode("ids").alias("at", "doc_id")).join(trusted, "doc_id", "left_semi")
    places = places.groupBy("block").agg(F.collect_list("at").alias("some"))  # no more than a block holds
    train = blocks.filter("marked").select("block", "packed", "lens").join(places.hint("merge"), "block").select("packed", "lens", "some")
    levels = model(train.mapInArrow(_trained, "model int, gram string, n long").groupBy("model", "gram").agg(F.sum("n").alias("n")))

    shards = partitions(spark)
    asked = staged(blocks.select("block", "packed", "lens").mapInArrow(_asked(shards), "block long, shard int, grams binary"), "quality-asked")
    dealt = asked.select("shard", "grams").repartition(shards, "shard").sortWithinPartitions("shard")
    wanted = staged(dealt.mapInArrow(_wanted, "shard int, model int, gram string").distinct(), "quality-wanted")
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    known = probabilities(wanted, levels).select("shard", "model", "gram", "p", nothing("long", "block"), nothing("binary", "grams"))
    both = known.unionByName(asked.select("shard", nothing("int", "model"), nothing("string", "gram"), nothing("double", "p"), "block", "grams"))
    both = both.repartition(shards, "shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
    answers = both.mapInArrow(_answered, "block long, shard int, nats binary").groupBy("block").agg(F.collect_list(F.struct("shard", "nats")).alias("answers"))
    return blocks.join(answers.hint("merge"), "block", "left").select("packed", "lens", "ids", "langs", "sizes", "answers").mapInArrow(_summed(shards), "doc_id long, lang string, size int, nats double")


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, low, high, kept for each row of ``docs`` (doc_id, text, lang).

    Trusted: labels.quality = 1. Empty and null texts have no perplexity and are not kept. Without trusted documents
    every other text is kept. A null language is one of its own; a language without enough trusted documents has the bounds of all. Rows without
    an id are judged by their text and never trusted. Repeated rows repeat theirs, equal texts have equal perplexities. Texts of any
    length are read whole; an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    out = staged(scored(rows, trusted).withColumn("class", F.least(F.floor(F.log2(F.greatest("size", F.lit(1)))), F.lit(20)).cast("int")), "quality-nats")
    sample = out.join(trusted.hint("merge"), "doc_id", "left_semi").filter("nats is not null")
    q = F.percentile_approx("nats", [LOW, 0.5, HIGH], 20_000)
    low, high = f"q[0] - {MARGIN} * (q[1] - q[0])", f"q[2] + {MARGIN} * (q[2] - q[1])"
    for n, keys in ((2, ["lang", "class"]), (1, ["lang"]), (0, [])):
        t = sample.groupBy(*keys).agg(F.count("*").alias("m"), q.alias("q"))
        if keys:
            t = t.filter(F.col("m") >= ENOUGH)
        t = staged(t.select(*keys, F.struct(F.expr(low).alias("low"), F.expr(high).alias("high")).alias(f"b{n}")), "quality-bounds")
        if keys:
            out = out.join(t, keys, "left")
        else:
            all_ = t.first()["b0"]
            whole = F.struct(F.lit(all_["low"]).cast("double").alias("low"), F.lit(all_["high"]).cast("double").alias("high"))
    out = out.withColumn("b", F.coalesce("b2", "b1", whole))
    inside = (F.col("nats") >= F.coalesce("b.low", F.lit(-math.inf))) & (F.col("nats") <= F.coalesce("b.high", F.lit(math.inf)))
    return out.select(
        "doc_id", "lang", F.col("size").cast("long").alias("n_chars"), F.exp("nats").alias("perplexity"), F.exp("b.low").alias("low"), F.exp("b.high").alias("high"),
        (F.col("nats").isNotNull() & inside).alias("kept"),
    )
