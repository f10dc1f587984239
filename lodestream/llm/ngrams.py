"""Blocks of packed texts, and character n-grams of whole blocks at once.

A block is one row: the ids, languages and sizes of some documents and their texts, packed together. Blocks are what the
n-gram model's joins move, since a block of texts is a third of its size packed, and what its documents ask of the model
is asked once a block instead of once a document.

n-grams are ORDER characters of any script, none folded onto another. Each document has a fold, by its text; the folds' models are
told apart from the start: a document is scored by the model that texts of other folds have trained.
"""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import kernels

ORDER, FOLDS = 4, 2
#: Bytes of text of a block (whole texts, at least one) and of the pieces in which it is worked on.
BLOCK, PIECE = 8 << 20, 1 << 18
#: Marks before a text's first and behind its last character; in a text they count as U+001A.
FIRST, LAST = "\x02", "\x03"
BLOCKS = "block long, marked boolean, ids array<long>, langs array<string>, sizes array<int>, lens array<int>, packed binary"
_U = np.uint64
_P, _Q = _U(0x9DDFEA08EB382D69), _U(0xC2B2AE3D27D4EB4F)


def pack(bits, bits_size: int):
    """Rows (doc_id, text, lang, size, mark) to BLOCKS; documents whose mark is among ``bits`` and others are packed apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        marked = np.unpackbits(bits.value)[:bits_size].astype(bool)
        number = TaskContext.get().partitionId() << 32
        held: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}

        def block(kind: bool) -> pa.RecordBatch:
            nonlocal number
            rows, held[kind], size[kind] = held[kind], [], 0
            texts = [r[2] for r in rows]
            data = [[number], [kind], [[r[0] for r in rows]], [[r[1] for r in rows]], [[r[3] for r in rows]], [[len(t) for t in texts]], [bz2.compress(b"".join(texts))]]
            number += 1
            kinds = [pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(d, k) for d, k in zip(data, kinds)], ["block", "marked", "ids", "langs", "sizes", "lens", "packed"])

        for batch in batches:
            raw = batch.column("text").cast(pa.binary())
            for i, t, lang, n, mark in zip(*(c.to_pylist() for c in (batch.column("doc_id"), raw, *(batch.column(c) for c in ("lang", "size", "mark"))))):
                kind = bool(mark is not None and marked[mark])
                held[kind].append((i, lang, t or b"", n))
                size[kind] += len(t or b"")
                if size[kind] >= BLOCK:
                    yield block(kind)
        for kind in (False, True):
            if held[kind]:
                yield block(kind)

    return run


def unpack(packed: bytes, lens: list[int]) -> list[bytes]:
    data, out, at = bz2.decompress(packed), [], 0
    for n in lens:
        out.append(data[at : at + n])
        at += n
    return out


def fold(text: bytes) -> int:
    return zlib.crc32(text) % FOLDS


def pieces(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of about PIECE bytes."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PIECE or i == len(texts) - 1:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def keys_of(chars: np.ndarray, model: np.ndarray) -> np.ndarray:
    """64-bit keys of n-grams (n x ORDER code points) and their models."""
    acc = model.astype(_U) * _Q
    for k in range(ORDER):
        acc = acc * _P + chars[:, k].astype(_U)
    return kernels.mix(acc, 55)


class Grams:
    """Of some texts: each character's n-gram (it and the ORDER - 1 before it) as key, model and owner; the closing mark's, too. Empty texts have none."""

    def __init__(self, texts: list[bytes], models: list[int]):
        clean = [t.decode("utf-8", "replace") for t in texts]
        clean = [t.replace(FIRST, "\x1a").replace(LAST, "\x1a") if FIRST in t or LAST in t else t for t in clean]
        some = [(i, len(t) + 1) for i, t in enumerate(clean) if t]
        self.points = np.frombuffer("".join(FIRST * (ORDER - 1) + t + LAST for t in clean if t).encode("utf-32-le"), np.uint32)
        if not some:
            self.at, self.owner, self.model, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
            return
        who, sizes = (np.array(x, np.int64) for x in zip(*some))
        # every place but a text's first ORDER - 1 ends an n-gram
        ends = np.ones(len(self.points), bool)
        starts = np.concatenate(([0], np.cumsum(sizes + ORDER - 1)[:-1]))
        for k in range(ORDER - 1):
            ends[starts + k] = False
        self.at = np.flatnonzero(ends)
        self.owner = np.repeat(who, sizes)
        self.model = np.array(models, np.int64)[self.owner]
        wide, n = self.points.astype(_U), len(self.points) - ORDER + 1
        acc = wide[:n].copy()
        for k in range(1, ORDER):
            acc *= _P
            acc += wide[k : n + k]
        weight = _U(int(_Q) * int(_P) ** ORDER % 2**64)
        self.keys = kernels.mix(acc[ends[ORDER - 1 :]] + self.model.astype(_U) * weight, 55)

    def chars(self, at: np.ndarray) -> np.ndarray:
        return np.stack([self.points[at - (ORDER - 1 - k)] for k in range(ORDER)], axis=1) if len(at) else np.zeros((0, ORDER), np.uint32)


class Known:
    """A growing set of keys, numbered as they came. Most lookups are one step in a table of the keys' leading bits; keys that lost their place there are searched."""

    def __init__(self):
        self.keys, self.chars, self.models = np.zeros(0, _U), np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
        self._laid()

    def _laid(self) -> None:
        n = len(self.keys)
        self.shift = _U(64 - max(12, (8 * n).bit_length()))
        self.table = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        place = (self.keys >> self.shift).astype(np.int64)
        self.table[place] = np.arange(n, dtype=np.int32)
        lost = np.flatnonzero(self.table[place] != np.arange(n))
        self.lost = lost[np.argsort(self.keys[lost])]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        out = self.table[(keys >> self.shift).astype(np.int64)]
        miss = np.flatnonzero((self.keys[out] != keys) | (out < 0))
        out[miss] = -1
        if len(self.lost) and len(miss):
            lost = self.keys[self.lost]
            at = np.minimum(np.searchsorted(lost, keys[miss]), len(lost) - 1)
            hit = lost[at] == keys[miss]
            out[miss[hit]] = self.lost[at[hit]]
        return out

    def add(self, g: Grams) -> np.ndarray:
        """The numbers of a piece's n-grams, new ones put in."""
        out = self.find(g.keys)
        new = np.flatnonzero(out < 0)
        if len(new):
            keys, first = np.unique(g.keys[new], return_index=True)
            some = new[first]
            self.keys, self.chars, self.models = np.concatenate((self.keys, keys)), np.concatenate((self.chars, g.chars(g.at[some]))), np.concatenate((self.models, g.model[some]))
            self._laid()
            out[new] = self.find(g.keys[new])
        return out


def strings(chars: np.ndarray) -> list[str]:
    """n-grams as text of ORDER characters each."""
    flat = np.ascontiguousarray(chars, np.uint32).tobytes().decode("utf-32-le", "replace")
    return [flat[i : i + ORDER] for i in range(0, len(flat), ORDER)]


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(-1, ORDER)


def known(texts: list[bytes], counted: list | None = None) -> Known:
    """The distinct n-grams of some texts; ``counted`` takes, for each piece, its first text, how many there are, how many n-grams each has, and their numbers."""
    out = Known()
    for first, some in pieces(texts):
        g = Grams(some, [fold(t) for t in some])
        numbers = out.add(g)
        if counted is not None:
            counted.append((first, len(some), np.bincount(g.owner, minlength=len(some)), numbers))
    return out


def asked(of: Known, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """What is asked of the model: shards, and the n-grams' numbers, by shard, model and characters."""
    shard = (of.keys % _U(shards)).astype(np.int64)
    order = np.lexsort((*(of.chars[:, k] for k in reversed(range(ORDER))), of.models, shard))
    return shard[order], order


def written(models: np.ndarray, chars: np.ndarray) -> bytes:
    """Sorted n-grams, packed: how many of each model, then the characters."""
    counts = np.bincount(models, minlength=FOLDS).astype(np.uint32)
    return counts.tobytes() + zlib.compress("".join(strings(chars)).encode())


def read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(models, code points) of `written`."""
    counts = np.frombuffer(data[: 4 * FOLDS], np.uint32)
    return np.repeat(np.arange(FOLDS), counts), points_of(zlib.decompress(data[4 * FOLDS :]).decode())
