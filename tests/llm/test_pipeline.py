"""The corpus pipeline, stage by stage, against brute-force versions."""

import hashlib
import math
import random

import pytest
from test_operators import linked, plain_kneser_ney, shingle_set, spans, words_of

import corpus_pipeline as p
from lodestream.llm import quality
from lodestream.llm.base import staged
from lodestream.llm.queries import piece_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """A folder of tables with clean, junk, copied, leaking and secret texts, rows without ids, repeated ids and odd texts."""
    r = random.Random(21)
    voc = ["".join(r.choice(["ba", "ko", "ri", "ten", "lu", "ma"]) for _ in range(r.randint(1, 3))) for _ in range(300)]
    text = lambda n: " ".join(r.choices(voc, k=n)).capitalize() + "."
    clean = [text(r.randint(60, 120)) for _ in range(150)]
    items = [" ".join(r.choices(voc, k=20)) for _ in range(4)]
    rows = [(i, t, "en") for i, t in enumerate(clean)]
    rows += [(1000 + i, text(80).replace(" ", " %$#"), "en") for i in range(12)]  # junk
    rows += [(None, text(80).replace(" ", " %$#"), "en"), (None, None, "en"), (None, "", None), (2000, None, "en"), (2001, "", "en"), (2002, " ", "en")]
    rows += [(3000 + i, clean[i], "en") for i in range(10)] + [(None, clean[11], "en"), (None, clean[12] + " extra", "en")]  # copies
    rows += [(4000 + i, text(50) + " " + items[i] + " " + text(50), "en") for i in range(4)] + [(None, text(50) + " " + items[0], "en"), (7, text(90) + " " + items[1], "en")]  # leaks, one under a used id
    rows += [(5000, text(60) + " password = abcdefgh12 " + text(20), "en"), (None, text(70) + " " + "0123456789abcdef" * 3, "en"), (8, text(90), "en"), (9, clean[9], "en"), (9, clean[9], "en")]
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    where = str(tmp_path_factory.mktemp("world"))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([*((i, 1, 0) for i in range(120)), (1000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([*enumerate(items), (99, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, rows, items


def collected(df):
    return sorted((tuple(x) for x in df.select(*p.COLUMNS).collect()), key=repr)


def clashing(docs):
    """Other columns, of names that the stages use inside."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in ("key", "group", "nth", "_spans", "blob", "nats", "id")})


def test_quality_equals_brute_force(spark, world):
    where, rows, _ = world
    trusted = [k for k, x in enumerate(rows) if x[0] is not None and x[0] < 120]
    nats, _ = plain_kneser_ney([x[1] for x in rows], trusted)
    size = lambda t: min(20, int(math.log2(max(1, len(t or "")))))

    def bounds(values):
        v = sorted(values)
        low, mid, high = (v[max(0, math.ceil(q * len(v)) - 1)] for q in (quality.LOW, 0.5, quality.HIGH))
        return low - quality.MARGIN * (mid - low), high + quality.MARGIN * (high - mid)

    sample = [(rows[k][2], size(rows[k][1]), nats[k]) for k in trusted]
    want = []
    for x, n in zip(rows, nats):
        if n is None:
            continue
        for own in ([v for lang, c, v in sample if lang == x[2] and c == size(x[1])], [v for lang, _, v in sample if lang == x[2]], [v for *_, v in sample]):
            if len(own) >= quality.ENOUGH:
                break
        low, high = bounds(own)
        assert min(abs(n - low), abs(n - high)) > 1e-6 or n in own
        if low - 1e-9 <= n <= high + 1e-9:
            want.append(x)
    got = collected(p.keep_quality(spark, clashing(spark.read.parquet(f"{where}/documents.parquet")), where))
    assert got == sorted(want, key=repr) and 150 < len(want) < len(rows) - 12


def test_one_of_each_group_equals_brute_force(spark, world):
    where, rows, _ = world
    distinct = sorted(set(rows), key=lambda x: (2**63 if x[0] is None else x[0], repr(x)))
    sets, root = linked([x[1] for x in distinct], 5)
    groups = {}
    for k, x in enumerate(distinct):
        groups.setdefault(root[k] if sets[k] else ("alone", k), []).append(x)
    got = collected(p.keep_one_of_group(spark, clashing(spark.read.parquet(f"{where}/documents.parquet")), where))
    assert len(got) == len(groups) < len(distinct) < len(rows)
    for members in groups.values():
        kept = [x for x in members if x in got]
        assert len(kept) == 1 and (kept[0][0] is None) == all(x[0] is None for x in members) and (kept[0][0] is None or kept[0][0] == min(x[0] for x in members if x[0] is not None))


def test_benchmark_passages_go(spark, world):
    where, rows, items = world
    sets = [shingle_set(words_of(t), 5) for t in items]
    leaks = [x for x in rows if any(len(s & shingle_set(words_of(x[1] or ""), 5)) >= 0.8 * len(s) for s in sets)]
    got = collected(p.drop_benchmark(spark, clashing(spark.read.parquet(f"{where}/documents.parquet")), where))
    assert len(leaks) == 6 and got == sorted([x for x in rows if x not in leaks], key=repr)


def test_secrets_are_masked(spark, world):
    where, rows, _ = world
    want = []
    for i, t, lang, source, n in rows:
        out, at = "", 0
        found = spans(t or "")
        for a, _, _, b in found:
            if a >= at:
                out += t[at:a] + "[secret]"
            at = max(at, b)
        want.append((i, out + t[at:], lang, source, len(out + t[at:])) if found else (i, t, lang, source, n))
    got = collected(p.redact_secrets(spark, clashing(spark.read.parquet(f"{where}/documents.parquet")), where))
    assert got == sorted(want, key=repr) and sum("[secret]" in (x[1] or "") for x in got) == 2


def test_tokens_equal_the_library(spark, world):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=piece_model())
    where, rows, _ = world
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = sp.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    got = p.tokenise(spark, clashing(spark.read.parquet(f"{where}/documents.parquet")), where)
    assert sorted((tuple(x) for x in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=repr) == sorted(want, key=repr)


def test_stages_chain_to_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in p.STAGES:
        docs = staged(stage(spark, docs, sf), "test")
        sizes.append(docs.count())
        if name != "sentencepiece":
            assert docs.columns == p.COLUMNS
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    assert sizes[2] < sizes[1] < sizes[0]
    assert sorted(map(tuple, p.run(spark, sf).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_tables_and_very_long_texts_pass_every_stage(spark, world):
    where, rows, _ = world
    long = rows[0][1] * 3000
    docs = spark.createDataFrame([(1, long, "en", "s", len(long)), (2, long, "en", "s", len(long))], SCHEMA)
    for name, stage in p.STAGES:
        assert stage(spark, docs.filter("false"), where).count() == 0, name
        assert stage(spark, docs, where).count() == (1 if name == "near_duplicates" else 2) or name == "quality", name
