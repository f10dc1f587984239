"""Phrase collocations, token files and schema rewrites against plain versions."""

import collections
import datetime
import hashlib
import math
import os
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestream.llm import collocations, files, rewrite, tokenfiles
from lodestream.llm.queries import byte_tokenizer, op12_token_files, op13_schema_rewrite

# --- phrases


def plain_phrases(docs, longest, least, covered=50, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, own in count.items():
        frequent = {p: a for p, a in own.items() if 2 <= len(p) and a >= least}
        rows = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in frequent.items()):
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), own[p[:k]], own[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, le, ri, n[lang], s) for i, (s, a, p, le, ri) in enumerate(rows[:top], 1)]
    return sorted(out)


def phrases_of(spark, docs, **more):
    df = spark.createDataFrame([(*d, "x") for d in docs], "text string, lang string, phrase string")
    return sorted(tuple(r) for r in collocations.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def chatter():
    rng = random.Random(5)
    words = ["New", "york", "city", "über", "alles", "a", "b", "c", "x|y", " ", "1.5", "naïve"]
    docs = [(" ".join(rng.choices(words, range(12, 0, -1), k=rng.randint(0, 60))), rng.choice(["en", "de", None])) for _ in range(300)]
    docs += [(None, "en"), ("", None), ("New York city\tNew  york\x0bcity" * 9, "en"), (" . , ", "fr"), ("one two one two one two", "fr")] + [("the same line of words here", "en")] * 40
    return docs


@pytest.mark.parametrize("longest", [2, 3, 4, 5])
def test_phrases_equal_plain_counts(spark, chatter, longest):
    got = phrases_of(spark, chatter, longest=longest, least=4)
    assert got == plain_phrases(chatter, longest, 4) and len(got) > 20


def test_a_ranks_bound_and_cover(spark, chatter):
    for more in ({"top": 7}, {"covered": 10}, {"covered": 101}):
        assert phrases_of(spark, chatter, longest=3, least=3, **more) == plain_phrases(chatter, 3, 3, **more)


def test_small_blocks_and_pieces_change_nothing(spark, chatter):
    """Blocks are cut in the worker, so this reads the generator itself: many blocks of few words, long texts cut between pieces."""
    code = """
import lodestream.llm.collocations as c
c.BLOCK, c.PIECE = 400, 50
"""
    df = spark.createDataFrame([(t or "", g or "und") for t, g in chatter] + [("one two, " * 500, "fr")], "text string, lang string")

    def run(batches):
        exec(code)
        from lodestream.llm.collocations import _words

        yield from _words(batches)

    rows = df.mapInArrow(run, "lang string, place long, word string, n long, seq binary").collect()
    words = [r for r in rows if r.seq is None]
    assert len({r.place >> collocations.PLACES for r in words}) > 20 and len({r.place for r in words}) == len(words)
    whole = collections.Counter()
    for r in words:
        whole[r.lang, r.word] += r.n
    assert whole["fr", "one"] == whole["fr", "two"] == 503
    seqs = {r.place >> collocations.PLACES: np.frombuffer(zlib.decompress(r.seq), np.int32) for r in rows if r.seq is not None}
    for r in words:
        assert (seqs[r.place >> collocations.PLACES] == r.place & ((1 << collocations.PLACES) - 1)).sum() == r.n


def test_counts_beyond_64_bits_are_exact(spark):
    a, le, ri = 3_000_000_017, 3_000_000_019, 4_999_999_999
    row = spark.createDataFrame([(a, [le, a], [ri, a])], "f long, pre array<long>, suf array<long>").select(collocations._cut(2, 1_000_000).alias("c")).first()["c"]
    assert (row["score"], row["k"], row["l"], row["r"]) == (1_000_000 * a * a // (le * ri), 1, le, ri)


def test_no_documents_have_no_phrases(spark):
    assert phrases_of(spark, []) == [] and phrases_of(spark, [(None, None), ("", "en"), (" ,\t. ", "en")]) == []


# --- token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=3000), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, share):
    a = np.array(ids, np.uint32)
    assert (tokenfiles.unpack(b"".join(tokenfiles.pack(a, share))) == a).all()


def test_blocks_of_outliers_are_small():
    rng = np.random.default_rng(1)
    ids = rng.integers(1000, 1064, 4096).astype(np.uint32)
    ids[::100] = 4_000_000_000
    data = tokenfiles.pack(ids)
    assert len(data) == 4 and sum(map(len, data)) < 4096 * 1.2 and (tokenfiles.unpack(b"".join(data)) == ids).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"ab1's\u00e9\u6f22 \t\n\r\xa0\u3000\x1c\x85.,", "<|endoftext|>", "  ", " \n", "'ll", "\U0001f642"]), max_size=40).map("".join))
def test_encoding_by_stretches_equals_the_library(text):
    from tokenizers import Tokenizer

    global _library, _encoder
    if "_library" not in globals():
        _library, _encoder = Tokenizer.from_file(byte_tokenizer()), tokenfiles.Encoder(byte_tokenizer())
    flat, bounds = _encoder.encode([text, "x " + text])
    assert flat[: bounds[1]].tolist() == _library.encode(text, add_special_tokens=False).ids
    assert flat[bounds[1] :].tolist() == _library.encode("x " + text, add_special_tokens=False).ids


def test_readers_find_any_stretch(tmp_path):
    rng = np.random.default_rng(3)
    docs = [(i if i % 7 else None, rng.integers(0, 60_000, rng.integers(0, 4000)).astype(np.uint32)) for i in range(60)]
    path = str(tmp_path / "a.pfr")
    with files.whole(path) as out:
        w = tokenfiles.Writer(out)
        for d in docs:
            w.put(*d)
        w.close()
    assert os.listdir(tmp_path) == ["a.pfr"]
    r, flat = tokenfiles.Reader(path), np.concatenate([d[1] for d in docs])
    assert r.n_ids == len(flat) and r.docs.to_pylist() == [d[0] for d in docs]
    for a, b in [(0, 0), (0, len(flat)), (1023, 1025), (5000, 5001), (len(flat) - 3, len(flat))]:
        assert (r.ids(a, b) == flat[a:b]).all()
    (tmp_path / "b.pfr").write_bytes(b"x" * 40)
    with pytest.raises(ValueError):
        tokenfiles.Reader(str(tmp_path / "b.pfr"))


def plain_tokens(rows, end=2):
    from tokenizers import Tokenizer

    library, at, out = Tokenizer.from_file(byte_tokenizer()), 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_the_query_equals_the_library(spark, sf):
    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = plain_tokens(sorted((d["doc_id"], d["text"]) for d in docs))
    assert sorted(tuple(r) for r in op12_token_files(spark, sf).collect()) == want


def test_odd_rows_in_token_files(spark):
    rows = [(None, "no id", 1), (3, None, 1), (3, "", 1), (3, "again", 1), (3, "again", 1), (-5, "first " * 4000, 1), (9, " ", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long")
    made = tokenfiles.write(df, byte_tokenizer(), end_id=2, per_file=1)
    got = tokenfiles.read(made).collect()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -5, 3, 3, 3, 3, 9] and made.count() == 7
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    for r in got:
        assert len(r.ids) == 4 * r.n_tokens and r.ids[-4:] == struct.pack("<I", 2)
    assert sorted(r.n_tokens for r in got if r.doc_id == 3)[:2] == [1, 1]
    assert tokenfiles.read(tokenfiles.write(df.limit(0), byte_tokenizer())).count() == 0
    bare = tokenfiles.read(tokenfiles.write(df, byte_tokenizer())).collect()
    assert sorted(r.n_tokens for r in bare) == sorted(r.n_tokens - 1 for r in got)


# --- schema rewrites


def plain_rewrite(rows):
    """(file_no, version, n_rows, n_nulls, ids, rows, start columns) by the contract, row by row."""
    names = ["client_id", "master_id", "source", "updated_at", "name", "email", "city", "nation_id", "segment", "balance"]
    rows = sorted(rows, key=lambda r: (zlib.crc32(str(r["client_id"]).encode()), r["client_id"]))
    size, out = 1 + len(rows) // 250, []
    for no in range(math.ceil(len(rows) / size)):
        v = zlib.crc32(f"19:{no}".encode()) % 24
        v = 0 if v > 15 else v
        nulls, lines, ids = 0, [], []
        for r in rows[no * size : (no + 1) * size]:
            r = dict(r)
            if v & 4:
                r |= {"nation_id": -1, "segment": "none"}
            if v & 8 and r["balance"] is not None:
                r["balance"] = float(np.float32(r["balance"]))
            nulls += sum(r[c] is None for c in names)
            t, b = r["updated_at"], r["balance"]
            micros = None if t is None else (t - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1)
            shown = [micros if c == "updated_at" else (None if b is None else math.floor(1048576 * b)) if c == "balance" else r[c] for c in names]
            lines.append("|".join("?" if x is None else str(x) for x in shown))
            ids.append(str(r["client_id"]))
        start = [n for n in names[1:] if not (v & 4 and n in ("nation_id", "segment"))]
        start = [{"name": "email", "email": "name"}.get(n, n) if v & 1 else n for n in start]
        start = ["client_id", *(start[::-1] if v & 2 else start)]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((no, v, len(lines), nulls, sha(",".join(ids)), sha("\n".join(lines)), ",".join(start), ",".join(names), v != 0))
    return out


def test_the_rewrite_equals_a_plain_one(spark, sf):
    want = plain_rewrite(pq.read_table(f"{sf}/clients.parquet").to_pylist())
    got = sorted(op13_schema_rewrite(spark, sf).collect())
    assert [tuple(r[c] for c in r.__fields__ if c != "path") for r in got] == want
    assert {r["version"] for r in got} >= {0, 1, 2, 4, 8} and sum(not r["rewritten"] for r in got) > 10
    folder = os.path.dirname(got[0]["path"])
    assert sorted(os.path.join(folder, f) for f in os.listdir(folder)) == sorted(r["path"] for r in got)
    for r in got:
        f = pq.ParquetFile(r["path"])
        assert rewrite.evolved_already(f.schema_arrow, rewrite.client_schema(None)) and f.metadata.num_rows == r["n_rows"]
    assert spark.read.parquet(folder).count() == sum(r["n_rows"] for r in got)


def test_odd_clients(spark, sf):
    df = spark.read.parquet(f"{sf}/clients.parquet")
    assert rewrite.drifted_clients(df.limit(0)).count() == 0
    one = df.limit(1).withColumn("path", df.name).withColumn("r", df.name)  # names that the operator uses itself
    odd = one.unionByName(one).unionByName(one.selectExpr(*[f"cast(null as {k}) as {c}" for c, k in one.dtypes]))
    odd = odd.unionByName(one.withColumn("balance", one.balance * float("inf"))).unionByName(one.withColumn("balance", one.balance * 1e300))
    got = rewrite.drifted_clients(odd).collect()
    assert sum(r["n_rows"] for r in got) == 5 and len(got) == 5 and got[0]["n_nulls"] + sum(r["n_nulls"] for r in got[1:]) >= 8


def test_plans_follow_ids_not_names(tmp_path):
    evolved = pa.schema([rewrite.with_id(pa.field(n, k), i) for i, (n, k) in enumerate([("a", pa.int64()), ("b", pa.string()), ("c", pa.float64())], 1)])
    found = pa.schema([rewrite.with_id(pa.field("a", pa.string()), 2), rewrite.with_id(pa.field("zz", pa.int32()), 1), rewrite.with_id(pa.field("gone", pa.int32()), 9)])
    batch = pa.RecordBatch.from_arrays([pa.array(["x", None]), pa.array([1, None], pa.int32()), pa.array([0, 0], pa.int32())], schema=found)
    got = rewrite.apply(batch, rewrite.plan(found, evolved, {3: 0.5}), evolved)
    assert got.to_pylist() == [{"a": 1, "b": "x", "c": 0.5}, {"a": None, "b": None, "c": 0.5}]
    assert rewrite.apply(batch, rewrite.plan(found, evolved, {}), evolved).column(2).null_count == 2
    for bad in (pa.schema([pa.field("a", pa.int64())]), pa.schema([found.field(0), found.field(0)])):
        with pytest.raises(ValueError):
            rewrite.plan(bad, evolved, {})


def test_a_rewrite_may_be_repeated(spark, tmp_path):
    """A second rewrite of the same table finds every file evolved; large files go through in batches."""
    evolved = pa.schema([rewrite.with_id(pa.field("a", pa.int64()), 1), rewrite.with_id(pa.field("b", pa.string()), 2)])
    n = 3 * rewrite.GROUP + 17
    old = pa.table({"a": pa.array(range(n), pa.int32())}, schema=pa.schema([rewrite.with_id(pa.field("a", pa.int32()), 1)]))
    os.makedirs(tmp_path / "t")
    pq.write_table(old, tmp_path / "t/x.parquet", row_group_size=5000)
    table = spark.createDataFrame([(str(tmp_path / "t/x.parquet"), "kept")], "path string, more string")
    first = rewrite.rewrite(table, evolved, {2: "none"}, str(tmp_path / "w")).first()
    assert first["rewritten"] and first["n_rows"] == n and first["more"] == "kept" and os.listdir(tmp_path / "t") == ["x.parquet"] and os.listdir(tmp_path / "w") == []
    assert first["ids_sha256"] == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert first["rows_sha256"] == hashlib.sha256("\n".join(f"{i}|none" for i in range(n)).encode()).hexdigest()
    again = rewrite.rewrite(table, evolved, {2: "none"}, str(tmp_path / "w2")).first()
    assert not again["rewritten"] and again["rows_sha256"] == first["rows_sha256"] and not os.path.exists(tmp_path / "w2")
    assert pq.read_table(tmp_path / "t/x.parquet").column("a").to_pylist() == list(range(n))
