"""Flat numpy kernels over the texts of an Arrow batch: words, shingles, sets, sketches.

All work on one byte array for many documents at once; `chunks` keeps that array small, whatever
a batch holds, so memory follows the longest document alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; ``seed`` picks one of many."""
    x = x + _U((int(seed) * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Flat:
    """Bytes of some texts, laid end to end: ``data`` and ``ends``, with ``first`` the row of the first text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first = data, bounds, first

    def __len__(self) -> int:
        return len(self.bounds) - 1


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Flat]:
    """The texts of a string column (null: empty) as pieces of about ``size`` bytes, whole texts only."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield Flat(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


_powers = np.ones(1, _U), np.ones(1, _U)
_P = 0x9DDFEA08EB382D69 | 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i up to n."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK + (CHUNK >> 2))
        inverse = pow(_P, -1, 2**64)
        _powers = tuple(np.concatenate(([_U(1)], np.cumprod(np.full(size - 1, p, _U)))) for p in (_P, inverse))
    return _powers


def _letters(seed: int) -> np.ndarray:
    return mix(np.arange(256, dtype=_U), seed) | _U(1)


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CODE = _letters(101)
_CODE_LOW = _CODE.copy()
_CODE_LOW[65:91] = _CODE[97:123]
#: Everything in ASCII but letters and digits parts words.
_NOT_ALNUM = np.ones(256, bool)
_NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def words(flat: Flat, parts: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased) and, for each text, the place of its first word; one more entry closes."""
    n = len(flat.data)
    if not n:
        return np.zeros(0, _U), np.zeros(len(flat) + 1, np.int64)
    inside = ~parts[flat.data]
    edge = np.zeros(n + 1, bool)
    edge[flat.bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    p, inverse = powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_CODE_LOW[flat.data] * p[:n], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))
    return h, np.searchsorted(starts, flat.bounds)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, and each text's bounds in them.

    A text of fewer words has one, its whole sequence; one without words has none.
    """
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(bounds[-1], _U)
    if len(h) >= k:
        acc = h[: len(h) - k + 1].copy()
        for j in range(1, k):
            acc *= _U(0xD6E8FEB86659FD93)
            acc += h[j : len(h) - k + 1 + j]
        acc = mix(acc, k)
        text = np.repeat(np.arange(len(count)), count)
        out_full = acc[text[: len(acc)] == text[k - 1 :]]
        full = np.repeat(count >= k, n)
        out[full] = out_full
    for t in np.flatnonzero((count > 0) & (count < k)):
        acc = _U(1000 + count[t])
        for x in h[first[t] : first[t + 1]]:
            acc = mix(np.array([acc], _U) + x, 7)[0]
        out[bounds[t]] = acc
    return out, bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[bounds[:-1][bounds[:-1] < len(values)]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return values[keep], total[bounds]


def similarity_sketch(values: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches (n x t) of non-empty sets; rows of empty sets stay at the largest value.

    Round i < t puts every element into a hashed bin with the value (i, hash); round t + b puts every
    element into bin b. A bin keeps its least value, so early rounds win, and after 2 t rounds every
    bin of a non-empty set is filled. A set is done as soon as its bins are full.
    """
    n = len(bounds) - 1
    none = _U(2**64 - 1)
    out = np.full(n * t, none, _U)
    size = np.diff(bounds)
    owner = np.repeat(np.arange(n), size)
    live, who = values, owner
    for i in range(t):
        h = mix(live, 2 * i + 1)
        key = who * t + (h % _U(t)).astype(np.int64)
        np.minimum.at(out, key, (_U(i) << _U(54)) | (mix(h, 2 * i + 2) >> _U(10)))
        open_ = (out.reshape(n, t) == none).any(axis=1) & (size > 0)
        if not open_.any():
            break
        if i & 1 or i < 4:
            stay = open_[who]
            live, who = live[stay], who[stay]
    else:
        grid = out.reshape(n, t)
        for s in np.flatnonzero(open_):
            own = values[bounds[s] : bounds[s + 1]]
            for b in np.flatnonzero(grid[s] == none):
                grid[s, b] = (_U(t + b) << _U(54)) | (mix(mix(own, 2 * (t + b) + 1), 2 * (t + b) + 2) >> _U(10)).min()
    return out.reshape(n, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band (n x bands)."""
    grid = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    acc = mix(grid[:, :, 0], 31)
    for r in range(1, rows):
        acc = mix(acc ^ mix(grid[:, :, r], 31), 32 + r)
    return acc
