"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of some documents in a row, in blocks of BLOCK ids. A block keeps its least id, and for each id the
difference to it in as many bits as a percentile of its differences needs; the few that need more stand whole in a list of exceptions. A
footer holds where each block starts and where each document starts, so any stretch of ids is read without the rest.

    file:   MAGIC, blocks, footer, footer's length (u64), MAGIC
    block:  least (u32), ids (u16), width (u8), exceptions (u16); packed differences; exceptions' places (u16) and differences (u32)
    footer: ids (u64), blocks (u64), documents (u64); blocks' starts (u64 each), documents' starts in ids (u64 each), their ids (i64 each), whether they have one (u8 each)

All numbers are little-endian.
"""

from __future__ import annotations

import gc
import itertools
import operator
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import files, kernels
from .base import partitions, small_batches, staged

MAGIC = b"LDSTPFR1"
#: Ids of a block, and the share of a block's differences that its width holds.
BLOCK, SHARE = 1024, 0.9
#: Ids that are packed or read at once, and ids after which a task begins another file.
RUN, FILE = 1 << 18, 1 << 27
#: Characters that are encoded at once, whole texts.
TEXT = 1 << 20
#: Distinct stretches of text whose ids a worker keeps.
CACHE = 500_000
_HEAD = struct.Struct("<IHBH")
_FOOT = struct.Struct("<QQQ")


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits that each number below 2^32 needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers to rows of bytes, ``width`` bits a number, the highest first."""
    size = 2 if width <= 16 else 4
    raw = values.astype(f">u{size}").view(np.uint8).reshape(-1, size)
    return np.packbits(np.unpackbits(raw, axis=1)[:, 8 * size - width :].reshape(len(values), -1), axis=1)


def _values(rows: np.ndarray, n: int, width: int) -> np.ndarray:
    """The ``n`` numbers of each row of `_bits`: each from the few bytes that hold it."""
    size = 3 if width <= 16 else 5
    kind = np.uint32 if width <= 16 else np.uint64
    bit = np.arange(n) * width
    wide = np.zeros((len(rows), rows.shape[1] + size), kind)
    wide[:, : rows.shape[1]] = rows
    out = wide[:, bit >> 3]
    for k in range(1, size):
        out <<= kind(8)
        out |= wide[:, (bit >> 3) + k]
    out >>= (8 * size - width - (bit & 7)).astype(kind)
    return (out & kind((1 << width) - 1)).astype(np.uint32)


def pack(ids: np.ndarray, share: float = SHARE) -> list[bytes]:
    """The blocks of ``ids`` (u32): all of BLOCK ids but the last."""
    out: list[bytes] = []
    whole = len(ids) // BLOCK * BLOCK
    for part in (ids[:whole].reshape(-1, BLOCK), ids[whole:].reshape(1, -1)):
        if not part.size:
            continue
        n, least = part.shape[1], part.min(axis=1)
        diff = (part - least[:, None]).astype(np.uint32)
        place = int(np.ceil(share * n)) - 1
        width = _widths(np.partition(diff, place, axis=1)[:, place])
        over = diff > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None]
        low = np.where(over, np.uint32(0), diff)
        packed: list[bytes] = [b""] * len(part)
        for w in np.unique(width[width > 0]).tolist():  # blocks of one width together
            rows = np.flatnonzero(width == w)
            for r, b in zip(rows.tolist(), _bits(low[rows], w)):
                packed[r] = b.tobytes()
        for r in range(len(part)):
            at = np.flatnonzero(over[r])
            out.append(_HEAD.pack(int(least[r]), n, int(width[r]), len(at)) + packed[r] + at.astype("<u2").tobytes() + diff[r][at].astype("<u4").tobytes())
    return out


def unpack(data: bytes) -> np.ndarray:
    """The ids of blocks that stand in a row."""
    at, out, groups = 0, [], {}
    while at < len(data):
        least, n, width, over = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        size = (n * width + 7) // 8
        groups.setdefault((n, width), []).append((len(out), at))
        out.append((least, n, at + size, over))
        at += size + 6 * over
    raw = np.frombuffer(data, np.uint8)
    ends = np.cumsum([n for _, n, _, _ in out])
    ids = np.empty(ends[-1] if len(ends) else 0, np.uint32)
    for (n, width), blocks in groups.items():
        size = (n * width + 7) // 8
        values = _values(np.stack([raw[a : a + size] for _, a in blocks]), n, width) if width else np.zeros((len(blocks), n), np.uint32)
        for (b, _), v in zip(blocks, values):
            least, _, exceptions, over = out[b]
            if over:
                v[np.frombuffer(data, "<u2", over, exceptions)] = np.frombuffer(data, "<u4", over, exceptions + 2 * over)
            ids[ends[b] - n : ends[b]] = v + np.uint32(least)
    return ids


class Writer:
    """Appends documents to a stream; memory holds RUN ids, and the index."""

    def __init__(self, out, share: float = SHARE):
        self.out, self.share, self.at, self.ids, self.held, self.waiting = out, share, len(MAGIC), 0, [], 0
        self.blocks: list[int] = []
        self.starts: list[int] = []
        self.docs: list[int | None] = []
        out.write(MAGIC)

    def put(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= RUN:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        cut = len(ids) if last else len(ids) // BLOCK * BLOCK
        for a in range(0, cut, RUN):  # a run is whole blocks
            for b in pack(ids[a : min(a + RUN, cut)], self.share):
                self.blocks.append(self.at)
                self.at += len(b)
                self.out.write(b)
        self.held, self.waiting = [ids[cut:]], len(ids) - cut

    def close(self) -> None:
        self._write(True)
        there = np.array([d is not None for d in self.docs], np.uint8)
        foot = _FOOT.pack(self.ids, len(self.blocks), len(self.docs)) + np.array(self.blocks, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes()
        foot += np.array([d or 0 for d in self.docs], "<i8").tobytes() + there.tobytes()
        self.out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)


class Reader:
    """A file's index, and its ids from any place on."""

    def __init__(self, path: str):
        where, name = files.place(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(8 + len(MAGIC), size - 8 - len(MAGIC))
        if tail[8:] != MAGIC:
            raise ValueError(f"no token file: {path}")
        length = struct.unpack("<Q", tail[:8])[0]
        self.end = size - 8 - len(MAGIC) - length
        foot = self.file.read_at(length, self.end)
        self.n_ids, blocks, docs = _FOOT.unpack_from(foot)
        at = _FOOT.size
        self.blocks = np.append(np.frombuffer(foot, "<u8", blocks, at).astype(np.int64), self.end)
        self.starts = np.append(np.frombuffer(foot, "<u8", docs, at + 8 * blocks).astype(np.int64), self.n_ids)
        ids = np.frombuffer(foot, "<i8", docs, at + 8 * (blocks + docs))
        self.docs = pa.array(ids, pa.int64(), mask=np.frombuffer(foot, np.uint8, docs, at + 8 * (blocks + 2 * docs)) == 0)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids in the places from ``first`` to ``last``, exclusive; only their blocks are read."""
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, (last - 1) // BLOCK + 1
        data = self.file.read_at(int(self.blocks[b] - self.blocks[a]), int(self.blocks[a]))
        return unpack(data)[first - a * BLOCK : last - a * BLOCK]

    def close(self) -> None:
        self.file.close()


_SPACE, _FEED, _MARKS = 32, 10, (44, 46)
#: Bytes before which a stretch begins; bytes of other white space, or that may be part of it; letters and digits.
_CUT, _ODD, _ALNUM = (np.zeros(256, bool) for _ in range(3))
_CUT[[_SPACE, _FEED, *_MARKS]] = True
_ODD[[0, 9, 11, 12, 13, *range(28, 32)]] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: White space beyond ASCII.
_WIDE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, no special tokens added.

    The byte-level pre-tokenizer ends a token before a single blank between other characters, around a single line feed, and before a comma or full stop behind
    a letter or digit. So texts are cut there, all at once in their bytes, and equal stretches, told apart by 128 bits of two hashes, are encoded once. A text in which
    white space stands in runs, or a mark behind another sign, is cut with more care. A word of LETTERS is one token before merges (the library itself is asked
    which characters it takes for letters) and goes to the library's model at once; other stretches go to its encoder.
    """

    LETTERS = "".join(map(chr, (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250))))

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # equal words never come twice
        self.model, parted = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        spans = [x for _, x in parted("a b.\nc1,")]
        if self.tokenizer.normalizer is not None or spans != [(0, 1), (1, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8)]:
            raise ValueError("not a byte-level tokenizer of the known kind")
        letters = "".join(c for c in self.LETTERS if len(parted(f" a{c}b")) == 1)
        self.shown = {ord(c): parted(c)[0][0] for c in letters + " "}
        self.blank = self.shown[32] if all(self.shown[ord(c)] == c for c in letters if c.isascii()) else None
        self.word = re.compile(f" ?[{letters}]+").fullmatch
        # all other ASCII signs but the apostrophe are one token with their like
        self.tailed = re.compile(f"( ?[{letters}]+)([!-&(-/:-@\\[-`{{-~]+)").fullmatch
        self.tails: dict[str, list[int]] = {}
        self.split, self.wide = re.compile(r"(?<=\S) (?=\S)").split, re.compile(f"[{_WIDE}]").search
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.strings: dict[str, int] = {}
        self.size = 0
        # of each stretch: its second hash, where its ids are, whether it is a word
        self.second, self.flat, self.ends, self.lone = np.zeros(1 << 14, np.uint64), np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, bool)

    def _words(self, words: list[str]) -> tuple[list, list[int]]:
        """The library's tokens of words, and how many each word has."""
        plain = [w.isascii() for w in words] if self.blank else [False] * len(words)
        # only the blank is shown otherwise in ASCII words
        joined = iter("\0".join(itertools.compress(words, plain)).replace(" ", self.blank or " ").split("\0"))
        found = list(map(self.model.tokenize, [next(joined) if p else w.translate(self.shown) for w, p in zip(words, plain)]))
        return found, list(map(len, found))

    def _tail(self, tail: str) -> list[int]:
        if tail not in self.tails:
            self.tails[tail] = self.tokenizer.encode(tail, add_special_tokens=False).ids
        return self.tails[tail]

    def _learn(self, new: list[str], second: np.ndarray) -> np.ndarray:
        """Numbers for new stretches, and their ids; arrays grow by doubling."""
        at, to = self.size, self.size + len(new)
        if to + 1 > len(self.ends):
            grown = lambda x: np.concatenate((x, np.zeros(to + len(x), x.dtype)))
            self.second, self.ends, self.lone = grown(self.second), grown(self.ends), grown(self.lone)
        lone = np.fromiter((m is not None for m in map(self.word, new)), bool, len(new))
        words = list(itertools.compress(new, lone))
        tokens, sizes = self._words(words)
        lens = np.zeros(len(new), np.int64)
        lens[lone] = sizes
        other: dict[int, list[int]] = {}
        hard, tailed = [], []
        for i in np.flatnonzero(~lone).tolist():
            m = self.tailed(new[i])
            (hard if m is None else tailed).append((i, m))
        if tailed:
            for (i, m), t in zip(tailed, self._words([m[1] for _, m in tailed])[0]):
                other[i] = [x.id for x in t] + self._tail(m[2])
        for k in range(0, len(hard), 1000):
            for (i, _), e in zip(hard[k : k + 1000], self.tokenizer.encode_batch([new[i] for i, _ in hard[k : k + 1000]], add_special_tokens=False)):
                other[i] = e.ids
        for i, ids in other.items():
            lens[i] = len(ids)
        ends = self.ends[at] + np.cumsum(lens)
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(int(ends[-1]), np.uint32)))
        own = np.repeat(lone, lens)
        flat = self.flat[self.ends[at] : ends[-1]]
        flat[own] = np.fromiter(map(operator.attrgetter("id"), itertools.chain.from_iterable(tokens)), np.uint32, int(own.sum()))
        for i, ids in other.items():
            flat[ends[i] - lens[i] - self.ends[at] : ends[i] - self.ends[at]] = ids
        self.ends[at + 1 : to + 1], self.second[at:to], self.lone[at:to], self.size = ends, second, lone, to
        return np.arange(at, to)

    def _by_hash(self, data: bytes, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of stretches of bytes, and which of them share a first hash with another stretch."""
        p, inverse = kernels.powers(len(raw))
        hashes = []
        for code in _CODES:
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(code[raw] * p[: len(raw)], out=sums[1:])
            hashes.append(kernels.mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
        keys, first, number = np.unique(hashes[0], return_index=True, return_inverse=True)
        second, known = hashes[1][first], self.known
        of = np.fromiter((known.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(of < 0)
        if len(new):
            cut = [data[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            of[new] = self._learn(cut, second[new])
            known.update(zip(keys[new].tolist(), of[new].tolist()))
        number = of[number]
        return number, self.second[number] != hashes[1]

    def _by_string(self, text: str) -> np.ndarray:
        """The numbers of a text's stretches from single blank to single blank."""
        first, *rest = self.split(text)
        cut = [first, *(" " + x for x in rest)]
        new = [s for s in dict.fromkeys(cut) if s not in self.strings]
        if new:
            self.strings.update(zip(new, self._learn(new, np.zeros(len(new), np.uint64)).tolist()))
        return np.fromiter(map(self.strings.__getitem__, cut), np.int64, len(cut))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text in them."""
        if self.size > CACHE:
            self.forget()
        each = [t.encode() for t in texts]
        lens = np.fromiter(map(len, each), np.int64, len(each))
        data, begins = b"".join(each), np.concatenate(([0], np.cumsum(lens)))
        raw = np.frombuffer(data, np.uint8)
        begin = begins[:-1][lens > 0]
        if len(raw):
            start = _CUT[raw]
            start[1:] |= raw[:-1] == _FEED
            start[begin] = True
            starts = np.flatnonzero(start)
            number, wrong = self._by_hash(data, raw, starts, np.append(starts[1:], len(raw)))
            head, size = raw[starts], np.diff(starts, append=len(raw))
            before, opens = np.append(np.uint8(0), raw)[starts], np.zeros(len(starts), bool)
            opens[np.searchsorted(starts, begin)] = True
            behind_word = np.append(False, self.lone[number[:-1]])
            wrong |= (head == _SPACE) & (size == 1)  # a blank before other white space, a mark, or nothing
            wrong |= (head == _FEED) & (opens | (before == _SPACE) | (before == _FEED))
            wrong |= np.isin(head, _MARKS) & (opens | ~(_ALNUM[before] | behind_word))
            row = np.searchsorted(begins, starts, "right") - 1
            odd = np.bincount(row, wrong, len(each)) > 0
            odd[np.searchsorted(begins, np.flatnonzero(_ODD[raw]), "right") - 1] = True
            last = np.flatnonzero(lens > 0)
            odd[last] |= raw[begins[last + 1] - 1] == _FEED
            bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(each)))))
        else:
            number, bounds, odd = np.zeros(0, np.int64), np.zeros(len(each) + 1, np.int64), np.zeros(len(each), bool)
        odd |= np.fromiter((not t.isascii() and self.wide(t) is not None for t in texts), bool, len(texts))
        if odd.any():
            own = [self._by_string(t) if x and t else number[a:b] for t, x, a, b in zip(texts, odd, bounds[:-1], bounds[1:])]
            number, bounds = np.concatenate(own), np.concatenate(([0], np.cumsum([len(n) for n in own])))
        sizes = self.ends[number + 1] - self.ends[number]
        after = np.concatenate(([0], np.cumsum(sizes)))
        where = np.arange(after[-1]) + np.repeat(self.ends[number] - after[:-1], sizes)
        return self.flat[where], after[bounds]


_CODES = [kernels.mix(np.arange(256, dtype=np.uint64), seed) | np.uint64(1) for seed in (211, 212)]
_encoders: dict[str, Encoder] = {}


def _written(tokenizer: str, end_id: int | None, folder: str, per_file: int):
    """Rows (doc_id, text) of a task, in order, to files; a row for each file: file, path, n_ids, n_docs."""
    names, kinds = ["file", "path", "n_ids", "n_docs"], [pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        gc.disable()  # the lists of ids hold no cycles
        encode, task = _encoders[tokenizer].encode, TaskContext.get().partitionId()
        tail = np.array([] if end_id is None else [end_id], np.uint32)

        def docs() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                texts, ids, at = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist(), 0
                while at < len(texts):  # about TEXT characters at once
                    to, size = at, 0
                    while to < len(texts) and (to == at or size + len(texts[to]) <= TEXT):
                        size += len(texts[to])
                        to += 1
                    flat, bounds = encode(texts[at:to])
                    for k in range(to - at):
                        yield ids[at + k], np.concatenate((flat[bounds[k] : bounds[k + 1]], tail))
                    at = to

        rows, number = docs(), 0
        row = next(rows, None)
        while row is not None:
            path = f"{folder}/tokens-{task:07d}-{number:05d}.pfr"
            with files.whole(path) as out:
                writer = Writer(out)
                while row is not None and writer.ids < per_file:
                    writer.put(*row)
                    row = next(rows, None)
                writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(((task << 24) + number, path, writer.ids, len(writer.docs)), kinds)], names)
            number += 1

    return run


def write(docs: DataFrame, tokenizer: str, *, end_id: int | None = None, per_file: int = FILE) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files in a new folder under the shared one; file, path, start (ids in all files before), n_ids, n_docs of each.

    Ascending doc_id, rows without one first; rows of one id stand in the order of their texts' hashes. A null text is empty: its document holds the
    end id alone, if there is one. Every text is encoded whole. Repeated rows are documents of their own. An empty table writes no file. Other columns,
    whatever their names, are ignored. Documents are dealt by ranges of ids, so that one task holds neighbours only; a task streams.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # rows of one id may be many: the hash and the row's place part them
    rows = rows.withColumns({"h": F.xxhash64("text"), "m": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("m")]
    dealt = rows.repartitionByRange(2 * partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    made = staged(dealt.mapInArrow(_written(tokenizer, end_id, files.new_folder(spark, "token-files"), per_file), "file long, path string, n_ids long, n_docs long"), "token-files")
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row a file
    return made.withColumn("start", F.coalesce(before, F.lit(0)))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, start) of files to their documents: doc_id, start, n_tokens, ids (u32, little-endian)."""
    names = ["doc_id", "start", "n_tokens", "ids"]
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            r, at = Reader(path), 0
            while at < len(r.docs):  # documents of about RUN ids at once
                to = max(at + 1, int(np.searchsorted(r.starts, r.starts[at] + RUN, "right")) - 1)
                ids = r.ids(int(r.starts[at]), int(r.starts[to])).astype("<u4")
                bounds = r.starts[at : to + 1] - r.starts[at]
                data = pa.Array.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer((4 * bounds).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([r.docs[at:to], pa.array(start + r.starts[at:to]), pa.array(np.diff(bounds)), data], names)
                at = to
            r.close()


def read(made: DataFrame) -> DataFrame:
    """The documents of files (path, start): doc_id, start (ids before it), n_tokens, ids (unsigned 32-bit integers, little-endian). A file is read by one task, in runs."""
    dealt = made.select("path", "start").repartition(2 * partitions(made.sparkSession), "path")
    return dealt.mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids binary")


def crc32_of(ids: str) -> Column:
    """The unsigned CRC-32 of a document's ids as they stand in ``ids``."""
    return F.crc32(ids)
