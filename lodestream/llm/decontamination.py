"""Benchmark decontamination by size-partitioned MinHash containment search.

After Zhu et al., "LSH Ensemble: Internet-Scale Domain Search" (VLDB 2016): a short item inside
a long document has a tiny Jaccard similarity, so one signature length can't serve all documents.
Documents are partitioned by the size of their shingle sets (powers of two), and each partition has
its own one-permutation MinHash whose number of bins follows its upper size, tuned so that an item
at the threshold shares no bin's minimum with a chance of MISS at most. Items are signed once for
every partition. A document is sketched first; only its bins' minima are looked up, and only among the
shingles that its partition's item signatures hold. Candidates so found are verified on the full sets in the same
task: no shuffle at all.

Items are the stated query set. They are broadcast in blocks of at most BLOCK_BYTES of text; a larger
set takes more passes over the documents, one block in memory at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels
from .base import small_batches, staged

WORDS, THRESHOLD, MISS = 5, 0.8, 1e-6
BLOCK_BYTES = 32 << 20
#: Bins for each shingle of a partition's largest document. Items too small for the last of these are signed with their whole set.
BINS = (1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1, 2, 4)
OUT = "doc_id long, item_id long, n_item long, n_shared long, containment double"
_U = np.uint64
#: Beyond ASCII, whatever is no letter, mark or number parts words; scripts written without blanks have a word a character, its marks included.
_PARTING = r"[^\x00-\x7F\p{L}\p{M}\p{N}]"
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsYi}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\x{30FC}&&\p{L}]"


#: A text without any of these has nothing but ASCII and Latin letters, and nothing to part: one class of ranges, where those above look up every character's properties.
_BEYOND = r"[\x80-\xBF\xD7\xF7\x{250}-\x{10FFFF}]"


def parted(text: Column) -> Column:
    """Text lower-cased beyond ASCII (`kernels.words` does the rest) whose words there are parted by blanks as those in ASCII are by punctuation."""
    spaced = F.regexp_replace(F.regexp_replace(F.lower(text), _PARTING, " "), f"({_UNSPACED}\\p{{M}}*)", " $1 ")
    return F.when(F.octet_length(text) == F.length(text), text).when(text.rlike(_BEYOND), spaced).otherwise(F.lower(text))


def bins_per_shingle(least: int, threshold: float = THRESHOLD, miss: float = MISS) -> float | None:
    """Bins for each shingle of a partition's largest document, for items of ``least`` shingles or more; None: keep all."""
    for a in BINS:
        kept = (1 - math.exp(-1 / a)) * a  # the chance that a shingle is its bin's minimum
        # the item's other shingles, a share of 1 - threshold, may hide a shared one in the item's own signature
        if (1 - kept) ** math.ceil(threshold * threshold * least) <= miss:
            return a
    return None


def minima(values: np.ndarray, owner: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Which values are the least of their bin; ``bins`` for each owner."""
    start = np.concatenate(([0], np.cumsum(bins)))
    bin_ = start[owner] + (kernels.mix(values, 5) % bins[owner].astype(_U)).astype(np.int64)
    rank = kernels.mix(values, 6)
    least = np.full(start[-1], _U(2**64 - 1), _U)
    np.minimum.at(least, bin_, rank)
    return rank == least[bin_]


def bins_of(a: float, part: int) -> int:
    """The bins of every signature of a partition, items' and documents' alike."""
    return max(1, int(a * 2**part))


class Index:
    """Signatures of the items for every size partition, and their full sets."""

    PARTS = 32  # sets of up to 2 ** 31 shingles

    def __init__(self, items: list[tuple[int, str | None]], threshold: float):
        self.threshold = threshold
        ids, texts = [i for i, _ in items], pa.array([t for _, t in items], pa.string())
        self.sets: list[np.ndarray] = []
        short: dict[int, dict[int, list[int]]] = {}
        for flat in kernels.chunks(texts):
            h, first = kernels.words(flat, kernels._NOT_ALNUM)
            count = np.diff(first)
            sets, bounds = kernels.distinct(*kernels.shingles(h, first, WORDS))
            self.sets += [sets[a:b] if n >= WORDS else sets[:0] for a, b, n in zip(bounds[:-1], bounds[1:], count)]
            for k in range(1, WORDS):
                values, bounds = kernels.shingles(h, first, k)
                for t in np.flatnonzero(count == k):
                    short.setdefault(k, {}).setdefault(int(values[bounds[t]]), []).append(flat.first + int(t))
        #: Items of fewer than WORDS words by their number of words: the one shingle's hash, sorted, and the items that have it.
        self.short = {k: (np.array(sorted(v), _U), [v[x] for x in sorted(v)]) for k, v in short.items()}
        self.ids = np.array(ids, np.int64)
        self.build()

    def build(self) -> None:
        """Sign the sets for every partition."""
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.tuned = [bins_per_shingle(int(n), self.threshold) for n in sizes]
        flat_sets = np.concatenate(self.sets) if self.sets else np.zeros(0, _U)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        #: The item's class: items of one tuning share the documents' bins.
        self.classes = sorted({a for a, n in zip(self.tuned, sizes) if n}, key=lambda a: a or 1e9)
        self.probed = self.held = 0  # shingles looked up, shingles of the documents seen
        own_class = {a: np.array([t == a for t in self.tuned])[owner] if len(owner) else np.zeros(0, bool) for a in self.classes}
        self.tables: dict[tuple[float | None, int], tuple[np.ndarray, np.ndarray]] = {}
        for a in self.classes:
            values, own = flat_sets[own_class[a]], owner[own_class[a]]
            order = np.argsort(values, kind="stable")
            values, own = values[order], own[order]
            for part in range(self.PARTS):
                self.tables[a, part] = values, own
                if a is not None:
                    # only the bins that hold something are laid out
                    bin_ = (kernels.mix(values, 5) % _U(bins_of(a, part))).astype(np.int64)
                    compact = np.unique(own << 34 | bin_, return_inverse=True)[1]
                    least = np.full(compact.max() + 1 if len(compact) else 0, _U(2**64 - 1), _U)
                    rank = kernels.mix(values, 6)
                    np.minimum.at(least, compact, rank)
                    signed = rank == least[compact]
                    if not signed.all():
                        self.tables[a, part] = values[signed], own[signed]

    def search_short(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
        """As `search`, for items of fewer than WORDS words: their words stand in the text in a row."""
        count, pairs = np.diff(first), set()
        for k, (keys, which) in self.short.items():
            values, bounds = kernels.shingles(h, first, k)
            owner = np.repeat(np.arange(len(count)), np.diff(bounds))
            at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
            for i in np.flatnonzero((keys[at] == values) & (count[owner] >= k)):
                pairs.update((int(owner[i]), j) for j in which[at[i]])
        return [(t, j, 1, 1) for t, j in sorted(pairs)]

    def search(self, sets: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, its size, shared) for each item that a text contains at the threshold."""
        size = np.diff(bounds)
        owner = np.repeat(np.arange(len(size)), size)
        part = np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
        pairs = set()
        for a in self.classes:
            sketch = slice(None) if a is None else minima(sets, owner, np.array([bins_of(a, p) for p in part.tolist()], np.int64))
            values, who = sets[sketch], owner[sketch]
            self.probed, self.held = self.probed + len(values), self.held + len(sets)
            of = part[who]
            for p in np.unique(of).tolist():
                keys, items = self.tables[a, p]
                mine = of == p
                probe, text = values[mine], who[mine]
                first = np.searchsorted(keys, probe)
                for i in np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == probe).tolist():
                    k = int(first[i])
                    while k < len(keys) and keys[k] == probe[i]:
                        pairs.add((int(text[i]), int(items[k])))
                        k += 1
        out = []
        for t, j in sorted(pairs):
            own, item = sets[bounds[t] : bounds[t + 1]], self.sets[j]
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[at] == item).sum())
            if shared >= self.threshold * len(item) - 1e-9:
                out.append((t, j, len(item), shared))
        return out


def _searched(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Index = index.value
        for batch in batches:
            docs, found = batch.column("doc_id").to_numpy(zero_copy_only=False), []
            for flat in kernels.chunks(batch.column("text")):
                h, first = kernels.words(flat, kernels._NOT_ALNUM)
                sets, bounds = kernels.distinct(*kernels.shingles(h, first, WORDS))
                if len(sets) and len(items.ids):
                    both = items.search(sets, bounds) + items.search_short(h, first)
                    found += [(int(docs[flat.first + t]), int(items.ids[j]), n, s, s / n) for t, j, n, s in both]
            names = ["doc_id", "item_id", "n_item", "n_shared", "containment"]
            columns = list(zip(*found)) if found else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment: every item of which a document holds ``threshold`` of the shingles.

    Shingles are five words; words are runs of letters (any script), marks and digits, lower-cased, so that case and
    punctuation don't matter; of scripts without blanks each character is a word. An item of fewer words is one shingle and is
    found wherever its words stand in a row; without words it is found nowhere, nor is anything in such a document. Null and
    empty texts hold nothing; rows without an id are left out of both; very long texts are read whole. Repeated rows, and different
    rows of one id, have their own rows of the result. An empty table on either side gives none. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), parted(F.col("text")).alias("text")).filter("doc_id is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), parted(F.col("text")).alias("text")).filter("item_id is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    out = None
    for b in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        index = spark.sparkContext.broadcast(Index([(r[0], r[1]) for r in mine.toLocalIterator()], threshold))  # BLOCK_BYTES of text, about
        found = staged(docs.mapInArrow(_searched(index), OUT), "contained")
        index.destroy()
        out = found if out is None else out.unionByName(found)
    return out
