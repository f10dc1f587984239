"""Interpolated modified Kneser-Ney trigrams over characters, counted and joined in Spark.

Counts are gathered per task, summed in shards of the n-gram's number, and joined with the totals of
their contexts and with the lower order, again by shards. The finished table is bounded by the
alphabet (SIZE to the third), whatever the corpus, and is laid out densely for scoring.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import staged
from .quality import discounts


@cache
def letters() -> np.ndarray:
    """Which code points are letters of any script, or marks, which belong to the letter before them."""
    return np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)])


class Alphabet:
    """A numbering of characters by fixed rules; 0 stands for line ends and other control characters."""

    def __init__(self, name: str):
        self.name = name
        lut = np.zeros(0x110000, np.int16)
        # letters a to z of either case, any other letter or mark, a digit; everything else is a word's bound
        self.size = 29
        lut[letters()] = 28
        for i in range(26):
            lut[65 + i] = lut[97 + i] = 1 + i
        lut[48:58] = 27
        self.lut = lut

    def codes(self, text: str) -> np.ndarray:
        """Numbers of the text's characters between two line ends before and one behind."""
        return self.lut[np.frombuffer(("\n\n" + text + "\n").encode("utf-32-le", "replace"), np.uint32)].astype(np.int32)

    def grams(self, text: str) -> np.ndarray:
        x = self.codes(text)
        return (x[:-2] * self.size + x[1:-1]) * self.size + x[2:]


def _counted(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet(name)
        total = np.zeros(alphabet.size**3, np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column("text"):
                if text.is_valid:
                    held.append(alphabet.grams(text.as_py()))
                    size += len(held[-1])
                    if size > total.size:  # one pass over the table pays only then
                        total += np.bincount(np.concatenate(held), minlength=total.size)
                        held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=total.size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["gram", "n"])

    return run


def _level(counts: DataFrame, size: int) -> DataFrame:
    """gram, low (the gram without its first character), part (n less discount over the context's total), gap (the mass the context leaves)."""
    d = discounts(counts)
    off = F.element_at(F.array(*[F.lit(x) for x in d]), F.least(F.col("n"), F.lit(3)).cast("int") + 1)
    rows = counts.withColumn("context", F.expr(f"gram div {size}")).withColumn("off", off)
    totals = rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("gap"))
    return rows.join(totals, "context").select("gram", "context", ((F.col("n") - F.col("off")) / F.col("total")).alias("part"), "gap")


class Model:
    """Dense table of negative log probabilities (nats) by the gram's number."""

    def __init__(self, docs: DataFrame, name: str):
        """``docs``: the texts to count (a column ``text``; nulls are left out). Without text all characters are equally likely."""
        self.alphabet = Alphabet(name)
        a = self.alphabet.size
        counts = docs.select("text").mapInArrow(_counted(name), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        tri = staged(counts, "charlm-3")
        bi = staged(tri.groupBy((F.col("gram") % (a * a)).alias("gram")).agg(F.count("*").alias("n")), "charlm-2")
        uni = bi.groupBy((F.col("gram") % a).alias("gram")).agg(F.count("*").alias("n")).toPandas()
        low = np.full(a, 0.5)
        low[uni["gram"].to_numpy(np.int64)] += uni["n"].to_numpy()
        p = low / low.sum()
        for level, counted in ((2, bi), (3, tri)):
            rows = _level(counted, a).toPandas()  # a ** level rows at most
            gap = np.ones(a ** (level - 1))
            gap[rows["context"].to_numpy(np.int64)] = rows["gap"].to_numpy()
            full = gap.reshape([a] * (level - 1))[..., None] * p[None] if level == 3 else gap[:, None] * p[None, :]
            full = full.reshape(-1).copy()
            full[rows["gram"].to_numpy(np.int64)] += rows["part"].to_numpy()
            p = full.reshape([a] * level)
        self.cost = -np.log(np.maximum(p, 1e-12)).astype(np.float32).reshape(-1)
        self.name = name
