"""Toxicity of deobfuscated text.

Noisy channel: a written symbol may stand for other letters (leetspeak), a symbol between letters for
nothing (spacing), and a letter for the one before it once more (repetition). Suspicious tokens
become lattices; Viterbi finds the likeliest letters under a character trigram model of the whole
corpus. The restored text's words and word beginnings are looked up in a lexicon that is
learned from labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .base import small_batches, staged
from .charlm import Alphabet, Model, letters

CUT = 0.3
#: Labelled documents to learn from, about (chosen by the hash of their ids); the corpus model reads every document.
SAMPLE = 40_000
#: Toxic documents that a feature must newly explain; the least precision of one whose documents others explain as well; the z of the lower bound of a precision.
SUPPORT, SURE, Z = 5, 0.95, 3.0
PREFIXES = (3, 4, 5, 6, 7)
CHUNK, BLOCK = 1 << 19, 256
#: Symbols of a token that are decoded at once, and how many more are looked at before those are settled; longer tokens are decoded window by window.
WINDOW, AHEAD = 2048, 64
# What a symbol may stand for besides itself.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e"}
SEPARATORS = " .-_*~,'·"
#: Costs in nats: a disguised letter, a digit or sign that is meant, a separator left out or kept, a repeat left out after one or more equal letters.
SWAP, PLAIN, DROP, KEEP, AGAIN, MANY = 1.0, 2.5, 0.4, 1.0, 3.0, 0.1
_MARK, _AT_END = "[013457890@$!|+€]", "[013457890@$€]"
_TRIGGER = re.compile(
    rf"[^\W\d_]{_MARK}+[^\W\d_]|(?<!\w){_MARK}+(?=[^\W\d_])|[^\W\d_]{_AT_END}+(?!\w)|([a-z])\1\1|(?<!\w)(?:[^\W_]|[@$€])(?:[ .\-_*~,'·](?:[^\W_]|[@$€])(?!\w)){{2,}}"
)
_RUN = re.compile(r"(.)\1{3,}")
#: Addresses, numbers of many digits and hashes aren't disguised words.
_ADDRESS, _PLAIN = re.compile(r"://|@\w+\."), re.compile(r"\d{5}|[0-9a-f]{16}")


@cache
def _kinds() -> np.ndarray:
    """For each code point: 1 letters, 2 other word characters, 4 marks, 8 what may be part of a disguised word."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            out[i] = 10 if c.isdecimal() else 9
    out[ord("_")] = 10
    for c in LEET:
        out[ord(c)] |= 12
    for c in SEPARATORS[1:]:
        out[ord(c)] |= 8
    return out


def suspicious(texts: list[str]) -> np.ndarray:
    """Which lower-cased texts can hold a match of the trigger: all that do, and some more; a dozen array operations for all texts.

    Every match has a mark beside a letter, or a run of marks before one, or three equal letters, or three lone characters one apart.
    """
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    c = np.frombuffer(("\n\n" + "\n".join(texts) + "\n\n").encode("utf-32-le", "replace"), np.uint32)  # text i starts at bounds[i] + 2
    kind = _kinds()[c]
    letter, mark = kind & 1 > 0, kind & 4 > 0
    hits = [np.flatnonzero((c[2:] == c[1:-1]) & (c[1:-1] == c[:-2]) & (c[2:] >= 97) & (c[2:] <= 122))]
    sure = mark & (c != ord("!")) & (c != ord("|")) & (c != ord("+"))  # the others end words as they are
    hits.append(np.flatnonzero((sure[1:] & letter[:-1]) | (letter[1:] & mark[:-1])))
    single = (kind & 3 > 0) | mark
    bound = (kind & 3 == 0) | (c == ord("_"))
    lone = np.zeros(len(c), bool)
    lone[1:-1] = single[1:-1] & bound[:-2] & bound[2:]
    hits.append(np.flatnonzero(lone[:-4] & lone[2:-2] & lone[4:]))
    out = np.zeros(len(texts), bool)
    at = np.concatenate(hits)
    # a hit lies within four places before or behind a character of its text
    for shift in (-2, 2):
        out[np.clip(np.searchsorted(bounds, np.maximum(at + shift - 2, 0), "right") - 1, 0, len(texts) - 1)] = True
    return out


class Decoder:
    """Viterbi over character lattices, many tokens at once."""

    def __init__(self, cost: np.ndarray):
        self.alphabet = Alphabet("letters")
        s = self.s = self.alphabet.size
        self.by_last = np.ascontiguousarray(cost.reshape(s, s, s).transpose(2, 0, 1))  # [c][a][b]
        self.known: dict[str, str] = {}

    def decode(self, tokens: list[str]) -> list[str]:
        """Restored tokens; what was decoded before is remembered up to a bound."""
        new = sorted({t for t in tokens if t not in self.known}, key=len)
        if len(self.known) > 200_000:
            self.known, new = {}, sorted(set(tokens), key=len)
        new = [t for t in new if t]
        self.known[""] = ""
        at = 0
        while at < len(new):  # tokens in order of length: a block's tables are BLOCK tokens of common length, or fewer long ones
            size = max(1, min(BLOCK, BLOCK * 48 // len(new[min(at + BLOCK, len(new)) - 1])))
            block = new[at : at + size]
            self.known.update(zip(block, self._block(block)))
            at += size
        return [self.known[t] for t in tokens]

    def _block(self, tokens: list[str]) -> list[str]:
        whole = [_RUN.sub(r"\1\1\1", t) for t in tokens]
        if max(map(len, whole)) <= WINDOW + AHEAD:
            return ["".join(out) for out, _ in self._paths(whole, [0] * len(whole), WINDOW + AHEAD, [(0, 0)] * len(whole))]
        done = []
        for t in whole:
            parts, at, state = [], 0, (0, 0)
            while at < len(t):
                out, states = self._paths([t], [at], WINDOW + AHEAD, [state])[0]
                n = len(out) if at + len(out) == len(t) else WINDOW
                parts += out[:n]
                at, state = at + n, states[n - 1]
            done.append("".join(parts))
        return done

    def _paths(self, tokens: list[str], froms: list[int], most: int, states: list[tuple[int, int]]) -> list[tuple[list[str], list[tuple[int, int]]]]:
        """For each token, from a place on and ``most`` symbols at most: what each symbol stands for ('' if left out), and the last two classes after it."""
        n, s = len(tokens), self.s
        sizes = [min(most, len(t) - a) for t, a in zip(tokens, froms)]
        ways = [[self._ways(t, a + i) for i in range(k)] for t, a, k in zip(tokens, froms, sizes)]
        dp = np.full((n, s, s), 1e9, np.float32)
        for j, (a, b) in enumerate(states):
            dp[j, a, b] = 0
        rows, back = np.arange(n), []
        for i in range(max(sizes)):
            live = np.array([i < k for k in sizes])
            new = np.full_like(dp, 1e9)
            how = np.full(dp.shape, -1, np.int8)
            came = np.zeros(dp.shape, np.int8)
            for k in range(max(len(w[i][0]) for w in ways if i < len(w))):
                some = np.array([i < len(w) and k < len(w[i][0]) for w in ways])
                r = rows[some]
                c = np.array([w[i][0][k][0] for w, y in zip(ways, some) if y])
                e = np.array([w[i][0][k][1] for w, y in zip(ways, some) if y], np.float32)
                step = dp[r] + self.by_last[c]  # over a, b
                a = step.argmin(1)
                best = step.min(1) + e[:, None]
                old = new[r, :, c]
                win = best < old
                new[r, :, c] = np.where(win, best, old)
                how[r, :, c] = np.where(win, k, how[r, :, c])
                came[r, :, c] = np.where(win, a, came[r, :, c])
            drops = [(j, w[i][1], w[i][2]) for j, w in enumerate(ways) if i < len(w) and w[i][1] is not None]
            for j, e, only in drops:
                stay = dp[j] + e
                if only is not None:
                    mask = np.full((s, s), 1e9, np.float32)
                    mask[:, only] = 0
                    stay = stay + mask
                win = stay < new[j]
                new[j] = np.where(win, stay, new[j])
                how[j] = np.where(win, 100, how[j])
            new -= np.where(live[:, None, None], new.min((1, 2), keepdims=True), 0)  # only differences count: long tokens stay exact
            dp = np.where(live[:, None, None], new, dp)
            back.append((how, came))
        out = []
        for j, (t, at, size) in enumerate(zip(tokens, froms, sizes)):
            last = dp[j] + (self.by_last[0] if at + size == len(t) else 0)
            a, b = divmod(int(last.reshape(-1).argmin()), s)
            letters, after = [""] * size, [(0, 0)] * size
            for i in range(size - 1, -1, -1):
                after[i] = a, b
                how = back[i][0][j, a, b]
                if how == 100:
                    continue
                letters[i] = chr(96 + b) if 1 <= b <= 26 else t[at + i]
                a, b = int(back[i][1][j, a, b]), a
            out.append((letters, after))
        return out

    def _ways(self, t: str, i: int) -> tuple[list[tuple[int, float]], float | None, int | None]:
        """For symbol i: (class, cost) choices, the cost of leaving it out if it may be, and the only letter before it then."""
        ch, cls = t[i], int(self.alphabet.lut[min(ord(t[i]), 0x10FFFF)])
        drop = only = None
        if ch in LEET:
            choices = [(ord(x) - 96, SWAP) for x in LEET[ch]] + [(cls, PLAIN)]
            if ch in "!|+" and i == len(t) - 1:
                choices = [(cls, 0.0)]
        elif ch in SEPARATORS:
            choices, drop = [(0, KEEP)], DROP
        elif cls == 27:
            choices = [(cls, PLAIN)]
        else:
            choices = [(cls, 0.0)]
        if i and ch == t[i - 1] and 1 <= cls <= 26:
            run = 1
            while i - run >= 0 and t[i - run] == ch:
                run += 1
            ahead = i
            while ahead + 1 < len(t) and t[ahead + 1] == ch:
                ahead += 1
            drop, only = (MANY if run + ahead - i > 2 else AGAIN), cls
        return choices, drop, only

    @staticmethod
    def _address(t: str, a: int, b: int) -> bool:
        """Whether the token, up to blanks, holds an address. Blanks inside a spaced word don't end it."""
        while a > 0 and not t[a - 1].isspace():
            a -= 1
        while b < len(t) and not t[b].isspace():
            b += 1
        return bool(_ADDRESS.search(t, a, b))

    def restore(self, texts: list[str]) -> list[str]:
        """Lower-cased texts with their suspicious tokens decoded."""
        texts = [t.lower() for t in texts]
        kinds = _kinds()
        found: list[list[tuple[int, int]]] = []
        for t, worth in zip(texts, suspicious(texts)):
            spans, to = [], 0
            if not worth:
                found.append(spans)
                continue
            for m in _TRIGGER.finditer(t):
                if m.start() < to:
                    continue
                a, b = m.start(), m.end()
                while a > to and kinds[ord(t[a - 1])] & 8:
                    a -= 1
                while b < len(t) and kinds[ord(t[b])] & 8:
                    b += 1
                to = b
                while b > a and not (t[b - 1].isalnum() or t[b - 1] in "@$€"):
                    b -= 1
                if 3 <= b - a and not _PLAIN.search(t, a, b) and not self._address(t, a, b):
                    spans.append((a, b))
            found.append(spans)
        whole = iter(self.decode([t[a:b] for t, s in zip(texts, found) for a, b in s]))
        out = []
        for t, spans in zip(texts, found):
            parts, at = [], 0
            for a, b in spans:
                parts += [t[at:a], next(whole)]
                at = b
            out.append("".join([*parts, t[at:]]) if spans else t)
        return out


@cache
def _unspaced() -> np.ndarray:
    """Code points of the letters of scripts written without blanks between words."""
    out = np.zeros(0x110000, bool)
    for a, b in ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)):
        out[a : b + 1] = True
    return out & letters()


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of lower-cased texts and each of its beginnings: hash, text, and the word's hash.

    In scripts without blanks each run of two, three and four characters is a word, too.
    """
    lut = Alphabet("letters").lut if not hasattr(features, "lut") else features.lut
    features.lut = lut
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    letter = np.concatenate(([False], (lut[points] != 0) & (lut[points] != 27), [False]))
    starts = np.flatnonzero(letter[1:-1] & ~letter[:-2])
    ends = np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1
    p, inverse = kernels.powers(len(points) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(kernels.mix(points.astype(np.uint64), 9) * p[: len(points)])))
    owner = np.searchsorted(bounds, starts, "right") - 1
    word = kernels.mix((sums[ends] - sums[starts]) * inverse[starts], 64).view(np.int64)
    hashes, owners, whole = [word], [owner], [word]
    for k in PREFIXES:
        some = ends - starts >= k
        hashes.append(kernels.mix((sums[starts[some] + k] - sums[starts[some]]) * inverse[starts[some]], k).view(np.int64))
        owners.append(owner[some])
        whole.append(word[some])
    run = _unspaced()[points]
    if run.any():
        total = np.concatenate(([0], np.cumsum(run)))
        for k in (2, 3, 4):
            at = np.flatnonzero(total[k:] - total[:-k] == k)
            h = kernels.mix((sums[at + k] - sums[at]) * inverse[at], 300 + k).view(np.int64)
            hashes.append(h)
            owners.append(np.searchsorted(bounds, at, "right") - 1)
            whole.append(h)
    return np.concatenate(hashes), np.concatenate(owners), np.concatenate(whole)


def twice(h: np.ndarray) -> np.ndarray:
    """The feature that two different words of a text share the feature ``h``."""
    return kernels.mix(np.asarray(h, np.int64).view(np.uint64), 222).view(np.int64)


def held(texts: list[str], base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, whether two words share it) among the sorted features ``base`` or all, each once a text, by text."""
    h, who, word = features(texts)
    if base is not None:
        at = np.minimum(np.searchsorted(base, h), max(0, len(base) - 1))
        hit = base[at] == h if len(base) else np.zeros(len(h), bool)
        h, who, word = h[hit], who[hit], word[hit]
    order = np.lexsort((word, h, who))
    h, who, word = h[order], who[order], word[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    other = np.zeros(len(h), np.int64)
    other[1:] = ~new[1:] & (word[1:] != word[:-1])
    starts = np.flatnonzero(new)
    more = np.add.reduceat(other, starts) > 0 if len(starts) else np.zeros(0, bool)
    return who[starts], h[starts], more


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about CHUNK characters."""
    texts, first, size = [], 0, 0
    for i, t in enumerate(batch.column("text")):
        texts.append(t.as_py() or "")
        size += len(texts[-1])
        if size >= CHUNK:
            yield first, texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield first, texts


def _restored(cost):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(cost.value)
        for batch in batches:
            for first, texts in _pieces(batch):
                kept = [batch.column(c).slice(first, len(texts)) for c in ("doc_id", "toxic")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(decoder.restore(texts), pa.string())], ["doc_id", "toxic", "text"])

    return run


def _looked(wanted, rows: bool):
    """Per restored text the features (single and twice) among ``wanted`` or all, or (``rows`` false) per task how many texts have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = None if wanted is None else wanted.value
        count = None if base is None else np.zeros((2, len(base)), np.int64)
        for batch in batches:
            for first, texts in _pieces(batch):
                who, h, more = held(texts, base)
                if not rows:
                    at = np.searchsorted(base, h)
                    np.add.at(count[0], at, 1)
                    np.add.at(count[1], at[more], 1)
                    continue
                h, who = np.concatenate((h, twice(h[more]))), np.concatenate((who, who[more]))
                order = np.argsort(who, kind="stable")
                sizes = np.bincount(who, minlength=len(texts))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(h[order], pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), lists], ["doc_id", "features"])
        if not rows:
            yield pa.RecordBatch.from_arrays([pa.array(base, pa.int64()), pa.array(count[0]), pa.array(count[1])], ["feature", "once", "twice"])

    return run


def _low(t: int, n: int) -> float:
    """Lower bound (Wilson) of the precision t / n."""
    p = t / n
    return float((p + Z * Z / (2 * n) - Z * np.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n))


def _chosen(toxic: np.ndarray, sets: list[np.ndarray]) -> tuple[dict[int, float], float]:
    """Features by greedy cover, each with its precision on what others left; and the share of toxic texts without any.

    A feature's rank is the lower bound of its precision over texts that no chosen one explains, so that a rare word earns nothing by
    standing in a text whose toxicity is explained already.
    """
    holders: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        for f in s.tolist():
            holders.setdefault(f, []).append(i)
    holders = {f: np.array(v) for f, v in holders.items()}
    whole = dict(holders)
    open_ = np.ones(len(sets), bool)
    out: dict[int, float] = {}
    while holders:
        best, rank = None, 0.0
        for f, v in list(holders.items()):
            rest = v[open_[v]]
            n, t = len(rest), int(toxic[rest].sum())
            if t < SUPPORT:
                del holders[f]
                continue
            low = _low(t, n)
            if low > CUT and (low * t, t) > (rank, 0):
                best, rank = f, low * t
        if best is None:
            break
        rest = holders.pop(best)
        rest = rest[open_[rest]]
        out[best] = float((toxic[rest].sum() + 0.5) / (len(rest) + 1))
        open_[rest] = False
    # words that others cover by now, but not always the same one (as in copies of one text), and that are all but sure by themselves
    place = {f: i for i, f in enumerate(out)}
    grid = np.zeros((len(sets), len(out)), bool)
    for i, s in enumerate(sets):
        grid[i, [place[f] for f in s.tolist() if f in place]] = True
    for f, v in whole.items():
        n, t = len(v), int(toxic[v].sum())
        if f not in out and _low(t, n) >= SURE and grid[v].mean(0).max(initial=0.0) <= 0.85:
            out[f] = float((t + 0.5) / (n + 1))
    left = int(open_.sum())
    return out, float((toxic[open_].sum() + 0.5) / (left + 1)) if left else 0.1


def _scored(cost, lexicon, base: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, (keys, odds) = Decoder(cost.value), lexicon.value
        for batch in batches:
            for first, texts in _pieces(batch):
                clean = np.zeros(len(texts))
                if len(keys):
                    who, h, more = held(decoder.restore(texts), keys)
                    at = np.searchsorted(keys, h)
                    np.add.at(clean, who, odds[0][at])
                    np.add.at(clean, who[more], odds[1][at[more]])
                score = 1 - (1 - base) * np.exp(clean)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(score)], ["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    Learns from labels whose crc32(doc_id) mod 4 isn't 2 alone. Null and empty texts get the score of a text without known
    features. Without labels every text has one low score. Rows without an id are scored, too, and not held out. Repeated rows repeat theirs;
    repeated or contradicting labels of an id count as toxic if one is. Texts of any length are read whole. An empty table gives no rows.
    Other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    known = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(remainder != 2).distinct()
    n = known.count()
    if n > SAMPLE:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(2**30)) < int(2**30 * SAMPLE / n))
    cost = spark.sparkContext.broadcast(Model(rows, "letters").cost)
    # About SAMPLE ids, a documented bound: a megabyte. Equal texts count once, as toxic if one of them is; they are decoded once.
    known = F.broadcast(known.withColumn("toxic", F.col("toxic").cast("int")))
    learn = rows.join(known, "doc_id").groupBy(F.xxhash64("text").alias("doc_id")).agg(F.max("toxic").alias("toxic"), F.any_value("text").alias("text"))
    learn = staged(learn.mapInArrow(_restored(cost), "doc_id long, toxic int, text string"), "toxic-learn")
    feats = learn.filter("toxic = 1").mapInArrow(_looked(None, True), "doc_id long, features array<long>")
    often = feats.select(F.explode("features").alias("feature")).groupBy("feature").agg(F.count("*").alias("t")).filter(F.col("t") >= SUPPORT)
    often = {r["feature"]: r["t"] for r in often.toLocalIterator()}  # bounded by the sample
    keys, odds, base = np.zeros(0, np.int64), np.zeros((2, 0)), 0.05
    if often:
        # "twice" features stand among them under hashes that no text has; their words are found through the single ones
        wanted = spark.sparkContext.broadcast(np.sort(np.array(list(often), np.int64)))
        counted = learn.mapInArrow(_looked(wanted, False), "feature long, once long, twice long").groupBy("feature").agg(F.sum("once").alias("once"), F.sum("twice").alias("twice"))
        good = []
        for r in counted.toLocalIterator():
            double = int(twice(np.array([r["feature"]], np.int64))[0])
            if (r["once"] and often[r["feature"]] / r["once"] > CUT) or (r["twice"] and often.get(double, 0) / r["twice"] > CUT):
                good.append(r["feature"])
        good = np.sort(np.array(good, np.int64))
        lexicon = spark.sparkContext.broadcast(good)
        got = staged(learn.mapInArrow(_looked(lexicon, True), "doc_id long, features array<long>").join(learn.select("doc_id", "toxic"), "doc_id"), "toxic-features")
        some = got.filter(F.size("features") > 0).toPandas()
        plain = got.filter(F.size("features") == 0).agg(F.count("*"), F.sum("toxic")).first()
        toxic = some["toxic"].to_numpy(np.int64)
        chosen, _ = _chosen(toxic, [np.asarray(x) for x in some["features"]])
        if chosen:
            both = np.array([[np.log(1 - chosen.get(int(f), 0.0)) for f in g] for g in (good, twice(good))])
            used = (both < 0).any(0)
            keys, odds = good[used], both[:, used]
            none = ~np.array([any(int(f) in chosen for f in x) for x in some["features"]], bool)
            base = min(float((plain[1] or 0) + toxic[none].sum() + 0.5) / float(plain[0] + none.sum() + 10), CUT / 2)
    scored = rows.mapInArrow(_scored(cost, spark.sparkContext.broadcast((keys, odds)), base), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
