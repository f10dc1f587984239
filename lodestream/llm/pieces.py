"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

Texts become one flat array of symbols. No merge crosses two characters that stand side by side in no
piece of the vocabulary, so the array is cut there, and equal segments are encoded once a chunk. Each
round finds every segment's best pair rank (segmented minimum), merges all its leftmost occurrences at
once, and compacts the array, until no pair remains. Runs of the space mark, whose pieces all
tie, are merged last, from the left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import small_batches

MARK = "▁"
#: Characters of a chunk; longer texts are cut where a space mark follows another character.
CHUNK = 1 << 20
_NONE = np.int64(2**62)
_cached: dict[str, Tokenizer] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class Tokenizer:
    """Tables of a BPE model file with byte fallback, a dummy prefix and no normalisation."""

    def __init__(self, model: bytes):
        pieces = [dict(_fields(x)) for n, x in _fields(model) if n == 1]
        text = [p.get(1, b"").decode() for p in pieces]
        score = [float(np.frombuffer(p.get(2, b"\0\0\0\0"), "<f4")[0]) for p in pieces]
        kind = [p.get(3, 1) for p in pieces]
        normal = {t: i for i, t in enumerate(text) if kind[i] == 1}
        self.bytes_id = np.zeros(256, np.int64)
        self.surface = [b""] * len(text)
        for i, t in enumerate(text):
            if kind[i] == 6:
                self.bytes_id[int(t[3:5], 16)] = i
                self.surface[i] = bytes([int(t[3:5], 16)])
            elif kind[i] == 1:
                self.surface[i] = t.replace(MARK, " ").encode()
        self.shown = [str(i).encode() for i in range(len(text))]
        # Symbols: piece ids; characters without a piece that occur in others get numbers above.
        chars = {c for t in normal for c in t}
        self.symbol = {c: normal[c] for c in chars if c in normal}
        for c in sorted(chars - self.symbol.keys()):
            self.symbol[c] = len(text) + len(self.symbol)
        self.unknown = 1 << 20  # + code point: other characters
        symbol_of = lambda s: normal.get(s, self.symbol.get(s) if len(s) == 1 else None)
        self.spaces = {len(t): i for t, i in normal.items() if t == MARK * len(t)}
        order = sorted((-score[i], i) for t, i in normal.items() if len(t) > 1 and t != MARK * len(t))
        rank = {i: r for r, (_, i) in enumerate(order)}
        if len({s for s, _ in order}) != len(order):
            raise ValueError("pieces other than spaces share a score")
        pairs = []
        for t, i in normal.items():
            if i in rank:
                for cut in range(1, len(t)):
                    a, b = symbol_of(t[:cut]), symbol_of(t[cut:])
                    if a is not None and b is not None:
                        pairs.append((a, b, rank[i], i))
        self._hash(pairs)
        self.lut = np.full(0x110000, -1, np.int32)
        self.char_no = np.zeros(0x110000, np.int16)
        for n, (c, s) in enumerate(sorted(self.symbol.items())):
            self.lut[ord(c)] = s
            self.char_no[ord(c)] = n + 1
        self.beside = np.zeros((len(self.symbol) + 1, len(self.symbol) + 1), bool)
        for t in normal:
            for a, b in zip(t, t[1:]):
                self.beside[self.char_no[ord(a)], self.char_no[ord(b)]] = True
        self.by_rank = np.array([i for _, i in order], np.int64)

    def _hash(self, pairs: list[tuple[int, int, int, int]]) -> None:
        """Open addressing: keys and ranks of all pairs that make a piece."""
        self.bits = max(16, (len(pairs) * 8).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int64)
        key = np.array([(a << 21) | b for a, b, _, _ in pairs], np.int64)
        rank = np.array([r for _, _, r, _ in pairs], np.int64)
        slot = self._slot(key)
        self.probes = 0
        while len(key):
            self.probes += 1
            free = self.slots[slot] == -1
            first = np.zeros(len(slot), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.slots[slot[put]], self.ranks[slot[put]] = key[put], rank[put]
            key, rank, slot = key[~put], rank[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 21) | right
        slot = self._slot(key)
        got = self.slots[slot]
        out = np.where(got == key, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((got != key) & (got != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            got = self.slots[slot[open_]]
            out[open_[got == key[open_]]] = self.ranks[slot[open_[got == key[open_]]]]
            open_ = open_[(got != key[open_]) & (got != -1)]
        return out

    def merged(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over segments of ``size`` symbols each; the symbols left and their numbers."""
        n = len(size)
        word = np.repeat(np.arange(n), size)
        rank = np.full(len(symbols), _NONE, np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            least = np.minimum.reduceat(rank, starts)
            length = np.diff(np.append(starts, len(word)))
            ready = np.repeat(least == _NONE, length)
            if ready.any():
                done_symbols.append(symbols[ready])
                done_words.append(word[ready])
                left = ~ready
                symbols, word, rank = symbols[left], word[left], rank[left]
                length, least = length[least != _NONE], least[least != _NONE]
                if not len(symbols):
                    break
            best = rank == np.repeat(least, length)
            # of overlapping occurrences every second one, from the left
            i = np.flatnonzero(best)
            fresh = np.concatenate(([True], i[1:] != i[:-1] + 1))
            run = np.arange(len(i)) - np.maximum.accumulate(np.where(fresh, np.arange(len(i)), 0))
            i = i[run % 2 == 0]
            symbols[i] = self.by_rank[rank[i]]
            keep = np.ones(len(symbols), bool)
            keep[i + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            at = place[i]
            for edge in (at, at[at > 0] - 1):
                ok = edge + 1 < len(symbols)
                rank[edge[~ok]] = _NONE
                edge = edge[ok]
                same = word[edge] == word[edge + 1]
                rank[edge[~same]] = _NONE
                edge = edge[same]
                rank[edge] = self.rank(symbols[edge], symbols[edge + 1])
        if not done_symbols:
            return symbols, np.zeros(n, np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=n)

    def _spaces(self, symbols: list[int]) -> list[int]:
        """A segment's runs of marks, merged from the left; other symbols stay."""
        mark, out, run = self.symbol[MARK], [], []
        for s in [*symbols, -1]:
            if s == mark:
                run.append(1)
                while len(run) > 1 and run[-2] + run[-1] in self.spaces:
                    run[-2:] = [run[-2] + run[-1]]
            else:
                out += [self.spaces[k] for k in run]
                run = []
                out.append(s)
        return out[:-1]

    def encode_flat(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids of ``text`` (marks put in already), and for each character the number of ids that start before it; one more closes."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        no = self.char_no[points]
        cut = np.concatenate(([True], ~self.beside[no[:-1], no[1:]] | (no[:-1] == 0) | (no[1:] == 0)))
        starts = np.flatnonzero(cut)
        size = np.diff(np.append(starts, len(points)))
        from . import kernels

        p, inverse = kernels.powers(len(points))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(kernels.mix(points.astype(np.uint64), 9) * p[: len(points)])))
        h = kernels.mix((sums[starts + size] - sums[starts]) * inverse[starts] + size.astype(np.uint64))
        _, first, back = np.unique(h, return_index=True, return_inverse=True)
        one, where = size[first], starts[first]
        offset = np.concatenate(([0], np.cumsum(one)))
        take = np.repeat(where - offset[:-1], one) + np.arange(offset[-1])
        symbols = self.lut[points[take]].astype(np.int64)
        symbols = np.where(symbols < 0, self.unknown + points[take], symbols)
        symbols, count = self.merged(symbols, one)
        offset = np.concatenate(([0], np.cumsum(count)))
        mark = self.symbol[MARK]
        twice = np.flatnonzero((symbols[1:] == mark) & (symbols[:-1] == mark))
        if len(twice):
            parts = np.split(symbols, offset[1:-1])
            for w in np.unique(np.searchsorted(offset, twice, "right") - 1):
                parts[w] = np.array(self._spaces(parts[w].tolist()), np.int64)
            count = np.array([len(x) for x in parts], np.int64)
            symbols = np.concatenate(parts)
            offset = np.concatenate(([0], np.cumsum(count)))
        odd = np.flatnonzero(symbols >= len(self.surface))
        if len(odd):  # characters without a piece: their UTF-8 bytes
            known = {v: ord(c) for c, v in self.symbol.items() if v >= len(self.surface)}
            spelled = {s: self.bytes_id[list(chr(known.get(s, s - self.unknown)).encode())] for s in np.unique(symbols[odd]).tolist()}
            width = np.ones(len(symbols), np.int64)
            width[odd] = [len(spelled[s]) for s in symbols[odd].tolist()]
            ids = np.repeat(symbols, width)
            at = np.cumsum(width) - width
            for i in odd.tolist():
                ids[at[i] : at[i] + width[i]] = spelled[int(symbols[i])]
            total = np.concatenate(([0], np.cumsum(width)))
            symbols, offset = ids, total[offset]
            count = np.diff(offset)
        each = count[back]
        ends = np.cumsum(each)
        take = np.repeat(offset[:-1][back] - (ends - each), each) + np.arange(ends[-1])
        before = np.zeros(len(points) + 1, np.int64)
        before[starts] = ends - each
        before[-1] = ends[-1]
        return symbols[take], before

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        at = 0
        while at < len(texts):
            if len(marked[at]) > CHUNK:
                out[at] = np.concatenate([self.encode_flat(x)[0] for x in _cut(marked[at])])
                at += 1
                continue
            to, total = at, 0
            while to < len(texts) and total + len(marked[to]) <= CHUNK:
                total += len(marked[to])
                to += 1
            # a line end between texts parts them: it has no piece beside another character
            ids, before = self.encode_flat("\n".join(marked[at:to]))
            place = 0
            for i in range(at, to):
                out[i] = ids[before[place] : before[place + len(marked[i])]]
                place += len(marked[i]) + 1
            at = to
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The UTF-8 text of some ids; the dummy prefix's space is taken off again."""
        out = b"".join(map(self.surface.__getitem__, ids))
        return out[1:] if ids and out[:1] == b" " and self.surface[ids[0]][:1] == b" " else out


def _cut(text: str) -> list[str]:
    parts, at = [], 0
    while len(text) - at > CHUNK:
        m = re.compile(f"[^{MARK}]{MARK}").search(text, at + CHUNK - 1)
        to = m.start() + 1 if m else len(text)
        parts.append(text[at:to])
        at = to
    return [*parts, text[at:]]


def tokenizer(path: str, model: bytes | None = None) -> Tokenizer:
    if path not in _cached:
        _cached[path] = Tokenizer(model if model is not None else open(path, "rb").read())
    return _cached[path]


def _coded(path: str, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, model.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = [x or "" for x in part.column("text").to_pylist()]
                n, shown, back = [], [], []
                for ids in t.encode(texts):
                    ids = ids.tolist()
                    n.append(len(ids))
                    shown.append(sha(b",".join(map(t.shown.__getitem__, ids))))
                    back.append(sha(t.decode(ids)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(shown), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; a null text is empty and has no ids.

    ``path``: the model file, read on the driver and broadcast (half a megabyte). Rows are coded where they are
    read: nothing is shuffled. Repeated rows repeat theirs; an empty table gives none.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(open(path, "rb").read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_coded(path, model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(path: str, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, model.value)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                ids = t.encode([x or "" for x in part.column("text").to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)), pa.array(np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in part.schema.names], lists], [*part.schema.names, "ids"])

    return run


def encoded(docs: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and ids array<int>, the text's tokens."""
    model = docs.sparkSession.sparkContext.broadcast(open(path, "rb").read())
    rows = docs.select(*columns)
    return rows.mapInArrow(_ids(path, model), T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
