"""Phrase collocations by hierarchical pair naming.

A phrase of k words is a pair of phrases of k - 1 words that overlap in all but their outer words. Level by level every text's
frequent (k - 1)-phrases stand as numbers in a row; each adjacent pair of them is counted over the whole corpus, and frequent
pairs get an id of their own, which replaces them in the texts. Rarer pairs can't be part of a frequent phrase. The two
numbers in a pair are its parents: the left ones lead to all beginnings of the phrase, the right ones to all its ends,
so the cuts and the phrases that a longer one covers are found by joins over ids.

Texts move as blocks: what a block holds is named, counted and asked for once a block, however often it occurs there, so
the commonest word or pair has as many rows as there are blocks. An id is the place (block and number) where its phrase stands first.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import hot_join, partitions, small_batches, staged

#: Bytes of text of a block, and of the pieces in which it is read. Longer texts are cut where a piece of the text ends.
BLOCK, PIECE = 16 << 20, 1 << 18
#: Bits of a place within its block, and of a block within its task.
PLACES, BLOCKS = 28, 13
#: The language of rows without one.
NO_LANG = "und"
_BREAK = b"\xff"  # in no UTF-8
_TABLE = bytearray(range(256))
_TABLE[65:91] = _TABLE[97:123]
_TABLE[9] = 32
for _c in (*b".,;:!?", *range(10, 14)):
    _TABLE[_c] = _BREAK[0]
_TABLE = bytes(_TABLE)
_SEQ = ["lang", "place", "word", "n", "seq"]
_SEQ_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
_PAIRS = ["place", "a", "b", "n", "seq"]
_PAIRS_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


class _Numbers(dict):
    """One language's words to numbers of the block, as they come; 0 is the bound between two pieces."""

    def __init__(self, count: Iterator[int]):
        super().__init__({_BREAK: 0})
        self.count = count

    def __missing__(self, word: bytes) -> int:
        self[word] = n = next(self.count)
        return n


def _parts(text: bytes) -> Iterator[bytes]:
    """A translated text in parts of about PIECE bytes that end between pieces of the text."""
    at = 0
    while len(text) - at > PIECE:
        cut = text.rfind(_BREAK, at, at + PIECE)
        if cut < 0:
            cut = text.find(_BREAK, at + PIECE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _packed(seq: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(seq, np.int32), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.int32)


class _Block:
    """What a task has read since its last block. Languages have words of their own."""

    def __init__(self):
        self.count, self.size, self.seqs = itertools.count(1), 0, [np.zeros(1, np.int32)]
        self.held: dict[str, list] = {}
        self.numbers: dict[str, _Numbers] = {}

    def put(self, lang: str, part: bytes) -> None:
        own = self.held.setdefault(lang, [0])
        own[0] += len(part)
        own.append(part)
        self.size += len(part)
        if own[0] >= PIECE:
            self.read(lang)

    def read(self, lang: str) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(self.count)
        words = (_BREAK.join(self.held.pop(lang)[1:]) + _BREAK).replace(_BREAK, b" \xff ").split()
        self.seqs.append(np.fromiter(map(self.numbers[lang].__getitem__, words), np.int32, len(words)))

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """The sequence of numbers (in the place 0), then each word with its place and count."""
        for lang in list(self.held):
            self.read(lang)
        seq = np.concatenate(self.seqs)
        n = np.bincount(seq)
        if len(n) == 1:
            return
        assert len(n) <= 1 << PLACES
        yield _batch([[None], [block << PLACES], [None], [None], [_packed(seq)]], _SEQ, _SEQ_KINDS)
        for lang, words in self.numbers.items():
            own = np.fromiter(words.values(), np.int64, len(words))[1:]
            names = pa.array(itertools.islice(words, 1, None), pa.binary()).cast(pa.string())
            yield _batch([pa.array([lang]).take(pa.array(np.zeros(len(own), np.int32))), (block << PLACES) + own, names, n[own], pa.nulls(len(own), pa.binary())], _SEQ, _SEQ_KINDS)


def _batch(columns: list, names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to blocks: a row with the sequence of its words' numbers, and a row for each distinct word of a language."""
    from pyspark import TaskContext

    number, held = TaskContext.get().partitionId() << BLOCKS, _Block()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
            for part in _parts(text.as_py().translate(_TABLE)):
                held.put(lang, part)
                if held.size >= BLOCK:
                    yield from held.rows(number)
                    number, held = number + 1, _Block()
    yield from held.rows(number)


def _pairs(last: bool):
    """Rows of blocks, each block's ids by place and then its sequence, to the adjacent pairs of ids: a sequence of the pairs' numbers unless they are the last, and a row for each distinct pair."""

    def of_block(block: int, places: np.ndarray, ids: np.ndarray, seq: np.ndarray) -> Iterator[pa.RecordBatch]:
        top = int(seq.max(initial=0)) + 1
        known = np.full(top, -1, np.int32)  # ids' numbers here
        known[places & ((1 << PLACES) - 1)] = np.arange(len(ids))
        seq = known[seq]
        at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
        keys, number, n = np.unique(seq[at].astype(np.int64) * len(ids) + seq[at + 1], return_inverse=True, return_counts=True)
        if not len(keys):
            return
        if not last:
            out = np.zeros(len(seq), np.int32)
            out[at] = number + 1
            yield _batch([[block << PLACES], [None], [None], [None], [_packed(out)]], _PAIRS, _PAIRS_KINDS)
        places = (block << PLACES) + 1 + np.arange(len(keys))
        yield _batch([places, ids[keys // len(ids)], ids[keys % len(ids)], n, pa.nulls(len(keys), pa.binary())], _PAIRS, _PAIRS_KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places, ids = None, [], []
        for batch in batches:
            block, place, id_ = (batch.column(c).fill_null(0).to_numpy() for c in ("block", "place", "id"))
            seqs, at = batch.column("seq"), 0
            for end in [*np.flatnonzero(np.diff(block)) + 1, len(block)] if len(block) else []:
                if block[at] != now:
                    now, places, ids = block[at], [], []
                seq = seqs[end - 1]  # a block's sequence is its last row
                stop = end - seq.is_valid
                places.append(place[at:stop])
                ids.append(id_[at:stop])
                if seq.is_valid:
                    if sum(map(len, ids)):
                        yield from of_block(int(now), np.concatenate(places), np.concatenate(ids), _unpacked(seq.as_py()))
                    now = None
                at = end

    return run


def _named(rows: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """Rows (place, keys, n) of keys that occur ``least`` times in all, with f, their count, and id: the first place, one for each key. A key has a row a block at most."""
    w = Window.partitionBy(*keys)
    rows = rows.withColumns({"f": F.sum("n").over(w), "id": F.min("place").over(w)}).filter(F.col("f") >= least)
    return staged(rows.drop("n"), name, "zstd")


def _dealt(blocks: DataFrame, named: DataFrame) -> DataFrame:
    """Each block in one task: its ids by place, then its sequence."""
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    block = F.shiftright("place", PLACES).alias("block")
    both = named.select(block, "place", "id", nothing("binary", "seq")).unionByName(blocks.select(block, nothing("long", "place"), nothing("long", "id"), "seq"))
    return both.repartition(2 * partitions(blocks.sparkSession), "block").sortWithinPartitions("block", F.col("place").asc_nulls_last())


def _with(rows: DataFrame, parents: DataFrame, side: str) -> DataFrame:
    """``rows`` with the struct ``side`` of the parent whose id is in the column ``side``_id; a parent of very many is in many tasks."""
    key = f"{side}_id"
    held = rows.groupBy(key).agg(F.count("*").alias("n")).join(parents.withColumnRenamed("id", key).hint("merge"), key)
    fields = [c for c in parents.columns if c != "id"]
    held = held.select(key, "n", F.struct(*fields).alias(side))
    return hot_join(rows, held, key, side, rows.count(), F.xxhash64("id"))


def phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[list[DataFrame], DataFrame]:
    """For each length from 1 to ``longest`` the phrases of ``docs`` (text, lang) that occur ``least`` times in their language; and lang, n: all its words.

    Columns: id, lang, phrase, last (its last word), f, pre and suf (counts of its beginnings and ends of 1, 2, ... words, itself included), left_id, right_id
    (ids of its first and last words but one; null for single words).
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    read = staged(rows.mapInArrow(_words, "lang string, place long, word string, n long, seq binary"), "phrase-words", "zstd")
    words = read.filter("seq is null").drop("seq")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = _named(words, ["lang", "word"], least, "phrase-1")
    none = F.lit(None).cast("long")
    level = named.filter("place = id").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("pre"), F.array("f").alias("suf"), none.alias("left_id"), none.alias("right_id"))
    out, blocks = [level], read.filter("seq is not null").select("place", "seq")
    for k in range(2, longest + 1):
        last = k == longest
        pairs = _dealt(blocks, named).mapInArrow(_pairs(last), "place long, a long, b long, n long, seq binary")
        if last:
            counted = pairs.groupBy("a", "b").agg(F.sum("n").alias("f"), F.min("place").alias("id")).filter(F.col("f") >= least)
        else:
            pairs = staged(pairs, f"phrase-pairs-{k}", "zstd")
            named, blocks = _named(pairs.filter("seq is null").drop("seq"), ["a", "b"], least, f"phrase-{k}"), pairs.filter("seq is not null").select("place", "seq")
            counted = named.filter("place = id")
        level = staged(counted.select("id", "f", F.col("a").alias("left_id"), F.col("b").alias("right_id")), f"phrase-ids-{k}")
        level = _with(level, out[-1].select("id", "lang", "phrase", "pre"), "left")
        level = _with(level, out[-1].select("id", "last", "suf"), "right")
        grown = lambda c: F.concat(c, F.array("f"))
        level = level.select(
            "id", "left.lang", F.concat_ws(" ", "left.phrase", "right.last").alias("phrase"), "right.last", "f", grown(F.col("left.pre")).alias("pre"), grown(F.col("right.suf")).alias("suf"), "left_id", "right_id",
        )
        out.append(staged(level, f"phrase-level-{k}"))
    return out, totals


def _cut(k: int, scale: int) -> Column:
    """Of the cuts of a phrase of k words the one with the least score, the shortest first part among equals: (score, k, l, r).

    Products have up to 38 digits; a count is at most either part's, so no score is over the scale.
    """
    wide = "cast({} as decimal(38,0))"
    cuts = []
    for j in range(1, k):
        left, right = f"pre[{j - 1}]", f"suf[{k - j - 1}]"
        score = f"({wide.format(scale)} * f * f) div ({wide.format(left)} * {right})"
        cuts.append(F.expr(f"struct({score} as score, {j} as k, {left} as l, {right} as r)"))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000, scale: int = 1_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``longest`` words.

    Scores are those of the weakest cut, floor(scale * a * a / (l * r)). A phrase goes if a longer frequent one that holds it occurs at least
    ``covered`` percent as often. A null language is `NO_LANG`, a null text is empty. Texts of any length are read whole, repeated rows count each time, ties
    are broken by count and then by the phrase's bytes. An empty table gives no rows; other columns, whatever their names, are ignored.
    """
    levels, totals = phrases(docs, longest, least)
    out = None
    for k in range(2, longest + 1):
        rows = levels[k - 1].withColumn("cut", _cut(k, scale))
        if k < longest:
            above = levels[k].select(F.explode(F.array("left_id", "right_id")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("above"))
            rows = rows.join(above.hint("merge"), "id", "left").filter(f"not coalesce(100 * above >= {covered} * f, false)")
        rows = rows.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
        out = rows if out is None else out.unionByName(rows)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = out.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
