"""Stores, streams and commits: what survives from cycle to cycle, and what a replay or a hot key does to it."""

import glob
import hashlib
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestream.functions import values as V
from lodestream.operators import bucketed, cluster, facts
from lodestream.operators.skew import with_value
from lodestream.streaming import commits, firsts


def doc(n):
    return hashlib.sha256(str(n).encode()).hexdigest()[:40]


def stores(spark, folder):
    yield bucketed.TableStore(spark, "title string, etag string, fetched_at timestamp")
    yield bucketed.BucketedStore(spark, f"{folder}/one", "title string, etag string, fetched_at timestamp", digits=1)
    yield bucketed.BucketedStore(spark, f"{folder}/two", "title string, etag string, fetched_at timestamp", digits=2, parts=3)


SCHEMA = "id string, content_hash string, title string, etag string, fetched_at timestamp, body string, arrival long"


def test_every_store_keeps_the_same(spark, tmp_path):
    import datetime as dt

    at = dt.datetime(2024, 3, 1)
    first = [(doc(1), "aa", "one", "e1", at, "body 1", 1), (doc(2), "bb", "two", None, at, None, 2), (doc(1), "cc", "one again", "e2", at, None, 3), (doc(3), "aa", "three", None, at, "body 3", 4)]
    second = [(doc(2), "dd", "two again", None, None, "body 2", 1), (doc(4), None, "four", None, at, None, 2), (doc(4), None, "four again", None, at, None, 3)]
    for s in stores(spark, tmp_path):
        assert s.documents().count() == 0 and s.by_id(spark.createDataFrame([(doc(1),)], "id string")).count() == 0 and s.listing().count() == 0
        s.put(spark.createDataFrame(first, SCHEMA))
        s.put(spark.createDataFrame(second, SCHEMA))
        s.put(spark.createDataFrame([], SCHEMA))
        assert [r["id"] for r in s.listing().collect()] == sorted(map(doc, (1, 2, 3, 4)))
        assert {r["title"] for r in s.documents().collect()} == {"one again", "two again", "three", "four again"}
        wanted = spark.createDataFrame([(doc(2),), (doc(9),), (doc(2),)], "id string")
        assert [r["title"] for r in s.by_id(wanted).collect()] == ["two again"]
        # the first to bring a hash owns it, whatever it holds now; a hash that only a null brought isn't known
        found = {r["content_hash"]: r["title"] for r in s.by_hash(spark.createDataFrame([(h,) for h in ("aa", "bb", "cc", "dd", "zz", None)], "content_hash string")).collect()}
        assert found == {"aa": "one again", "bb": "two again", "cc": "one again", "dd": "two again"}
        ids = spark.createDataFrame([(doc(n),) for n in (1, 2, 3, 4)], "id string")
        assert {r["id"]: r["body"] for r in s.bodies(ids).collect()} == {doc(1): "body 1", doc(2): "body 2", doc(3): "body 3"}
        asked = spark.createDataFrame([(doc(1), "e2", None), (doc(1), "other", 1000), (doc(3), None, 10**12), (doc(3), None, 1000), (doc(4), "e", None), (doc(8), None, None)], "id string, etag string, max_age long")
        assert Counter(r["fresh"] for r in s.fresh(asked, F.lit("2024-03-02").cast("timestamp")).collect()) == Counter({True: 3, False: 3})
        with pytest.raises(Exception, match="unsafe document id"):
            s.put(spark.createDataFrame([("../x", "h", "t", None, None, None, 1)], SCHEMA))


def test_a_put_reads_and_writes_only_its_buckets(spark, tmp_path):
    s = bucketed.BucketedStore(spark, str(tmp_path / "s"), "title string", digits=2)
    rows = [(doc(n), f"{n:04x}", str(n), n) for n in range(2000)]
    schema = "id string, content_hash string, title string, arrival long"
    s.put(spark.createDataFrame(rows, schema))
    state = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(str(tmp_path / "s/documents/**/*.parquet"), recursive=True)}
    before = state()
    mine = [r for r in rows if r[0][:2] in ("0a", "7f", "e3")]
    some = spark.createDataFrame([(i, h, t + "!", a) for i, h, t, a in mine], schema)
    s.put(some)
    after = state()
    changed = {os.path.basename(os.path.dirname(f)) for f in before.keys() ^ after.keys()} | {f for f in before.keys() & after.keys() if before[f] != after[f]}
    assert len(before) == 256 and changed == {"bucket=0a", "bucket=7f", "bucket=e3"}
    assert {r["title"] for r in s.documents().filter("generation = 2").collect()} == {t + "!" for _, _, t, _ in mine}
    assert s.documents().count() == 2000
    read = {os.path.basename(os.path.dirname(f)) for f in s.by_id(some.select("id")).inputFiles()}
    held = s._within("documents", some, "id")[0]
    files = {r[0].split("/")[-2] for r in held.select(F.input_file_name()).distinct().collect()}
    assert files == {"bucket=0a", "bucket=7f", "bucket=e3"} and read >= files


def test_a_hot_id_in_a_put(spark, tmp_path):
    s = bucketed.BucketedStore(spark, str(tmp_path / "s"), "title string", digits=1)
    puts = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(doc(1))).otherwise(F.sha2(F.col("id").cast("string"), 256).substr(1, 40)).alias("id"), F.lit("aa").alias("content_hash"), F.col("id").cast("string").alias("title"), F.col("id").alias("arrival"))
    s.put(puts)
    assert s.documents().count() == 20_000 and s.by_id(spark.createDataFrame([(doc(1),)], "id string")).first()["title"] == "29997"


def test_a_second_cycle_reads_what_the_first_stored(spark, sf, tmp_path):
    from lodestream.plans import etl, queries

    items, _, pages = queries.etl_inputs(spark, sf)
    kept = bucketed.BucketedStore(spark, str(tmp_path / "kept"), etl.STORED, digits=1)
    first = {(r["cluster_id"], r["url"]): r for r in etl.run_with_store(items, kept, pages).documents.collect()}
    good = {r["id"] for r in first.values() if r["extraction"] != "failed"}
    assert {r["origin"] for r in first.values()} >= {"feed", "hint", "fetch"} and {r["id"] for r in kept.documents().collect()} == {r["id"] for r in first.values()}
    second = {(r["cluster_id"], r["url"]): r for r in etl.run_with_store(items, kept, pages).documents.collect()}
    assert {r["id"] for r in second.values() if r["origin"] == "store"} == good
    for key, r in second.items():
        if r["origin"] == "store":
            assert (r["body"], r["content_hash"], r["word_count"]) == (first[key]["body"], first[key]["content_hash"], first[key]["word_count"])
    assert {r["generation"] for r in kept.documents().collect()} == {1, 2} or good == {r["id"] for r in first.values()}


# --- the story graph


def test_equal_titles_are_one_class(spark):
    n = 10_000
    items = spark.range(n).select(F.lit("t").alias("topic"), F.col("id").alias("ord"), F.array(F.lit("moon"), F.lit("lands"), F.lit("probe")).alias("tokens"))
    more = spark.createDataFrame([("t", n, ["probe", "lands", "moon", "again"]), ("t", n + 1, []), ("t", n + 2, []), ("t", n + 3, ["other", "story"]), ("u", 0, ["moon", "lands", "probe"])], "topic string, ord long, tokens array<string>")
    classes = cluster.token_classes(items.unionByName(more))
    first = cluster.representatives(classes)
    assert first.count() == 6
    pairs = cluster.similar_pairs(first, V.THETA)
    assert [(r["topic"], r["i"], r["j"]) for r in pairs.collect()] == [("t", 0, n)]
    linked = {(r["topic"], r["ord"]): r for r in cluster.links(classes, pairs).collect()}
    assert len(linked) == n + 5 and linked["t", 5]["links"] == n and linked["t", n]["links"] == n and linked["t", 7]["class"] == 0
    assert all(linked[k]["links"] == 0 for k in (("t", n + 1), ("t", n + 2), ("t", n + 3), ("u", 0)))


def test_titles_with_common_words_are_not_compared(spark):
    """Each title has two words that all have and four of its own, so no two are similar; comparing all that share a word would make 79,800 pairs."""
    own = [F.concat(F.lit("own"), F.col("id").cast("string"), F.lit(c)) for c in "abcd"]
    items = spark.range(400).select(F.lit("t").alias("topic"), F.col("id").alias("ord"), F.array(F.lit("hot"), F.lit("story"), *own).alias("tokens"))
    near = spark.createDataFrame([("t", 400, ["hot", "story", "own0a", "own0b", "own0c", "new"])], "topic string, ord long, tokens array<string>")
    assert [tuple(r) for r in cluster.candidates(items.unionByName(near), V.THETA).collect()] == [("t", 0, 400)]
    assert [tuple(r)[:5] for r in cluster.similar_pairs(items.unionByName(near), V.THETA).collect()] == [("t", 0, 400, 5, 0)]


@pytest.mark.parametrize("theta", [0.3, 0.5, 0.82, 1.0, 1.7])
def test_no_similar_pair_is_missed(spark, theta):
    r = random.Random(7)
    words = [f"word{k}" for k in range(20)] + list(V.IMPORTANT_TOKENS[:6])
    rows = [(t, n, r.sample(words[: r.choice((6, 26))], r.randint(0, 6))) for t in ("t", "u") for n in range(150)]
    sets = [(t, n, set(w)) for t, n, w in rows if w]
    want = {}
    for t, i, a in sets:
        for u, j, b in sets:
            if t == u and i < j:
                sim = (len(a & b) + 1.5 * len(a & b & set(V.IMPORTANT_TOKENS))) / min(len(a), len(b))
                if sim >= theta and a & b:
                    want[t, i, j] = (len(a & b), sim)
    got = cluster.similar_pairs(spark.createDataFrame(rows, "topic string, ord long, tokens array<string>"), theta).collect()
    assert len(got) == len(want) and {(x["topic"], x["i"], x["j"]): (x["overlap"], x["sim"]) for x in got} == want


def test_pairs_of_classes_become_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(cluster, "PART", 3)
    r = random.Random(5)
    words = ["moon", "lands", "probe", "again", "openai"]
    rows = [(t, n, r.sample(words, r.randint(0, 5))) for t in ("t", "u") for n in range(60)] + [("t", 60 + n, ["hot", "story"]) for n in range(40)]
    items = spark.createDataFrame(rows, "topic string, ord long, tokens array<string>")
    classes = cluster.token_classes(items)
    got = [tuple(x) for x in cluster.expanded(classes, cluster.similar_pairs(cluster.representatives(classes), V.THETA)).collect()]
    assert sorted(got) == sorted(tuple(x) for x in cluster.similar_pairs(items, V.THETA).collect())
    assert len(set(got)) == len(got) >= 40 * 39 // 2


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_leave_leaders_as_they_are(spark, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(7)] + ["kubernetes", "openai"]
    sets = [frozenset(r.sample(words, r.randint(0, 4))) for _ in range(120)]
    heads, want = [], []
    for i, s in enumerate(sets):
        near = [h for h in heads if s and sets[h] and (len(s & sets[h]) + 1.5 * len(s & sets[h] & set(V.IMPORTANT_TOKENS))) / min(len(s), len(sets[h])) >= V.THETA]
        want.append(near[0] if near else i)
        heads += [] if near else [i]
    items = spark.createDataFrame([("t", i, r.sample(sorted(s), len(s))) for i, s in enumerate(sets)], "topic string, ord long, tokens array<string>")
    got = cluster.clustered(items).orderBy("ord").collect()
    assert [g["leader"] for g in got] == want
    assert [g["n"] for g in got] == [sorted(set(want)).index(w) for w in want]


def test_joins_with_hot_and_null_keys(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3 * 7).otherwise(F.when(F.col("id") % 2 == 0, F.col("id"))).alias("a"), F.when(F.col("id") % 5 > 0, "x").alias("b"), F.col("id"))
    table = rows.groupBy("a", "b").agg(F.count("*").alias("n")).filter("a is not null and b is not null").withColumn("v", F.concat_ws("-", "a", "b"))
    got = with_value(rows, table, ["a", "b"], "v", rows.count()).collect()
    assert len(got) == 5000 and all(r["v"] == (None if r["a"] is None or r["b"] is None else f"{r['a']}-{r['b']}") for r in got)


# --- the verbatim screen


def test_the_screen_is_linear_and_exact(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(r.choices(words, k=n))
    bodies = [text(200) for _ in range(40)] + ["seven words are too few for it", ""]
    docs = [(i, text(60)) for i in range(200)]
    docs += [(200 + i, text(20) + " " + " ".join(b.split()[5 : 5 + k]) + " " + text(20)) for i, (b, k) in enumerate([(bodies[0], 8), (bodies[1], 7), (bodies[2], 30)])] + [(300, bodies[40]), (301, ""), (302, None)]
    grams = lambda t: {tuple(t.split()[i : i + 8]) for i in range(len(t.split()) - 7)}
    known = set().union(*map(grams, bodies))
    want = sorted(i for i, t in docs if t and grams(t) & known)
    got = facts.verbatim(spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame([(b,) for b in bodies], "text string"))
    assert sorted(x["id"] for x in got.collect()) == want == [200, 202]
    none = facts.verbatim(spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame([], "text string"))
    assert none.count() == 0

    def seconds(n):
        one = spark.createDataFrame([(1, " ".join(f"u{i}" for i in range(n)))], "id long, text string")
        best = 1e9
        for _ in range(2):
            began = time.time()
            facts.verbatim(one, one).count()
            one.select(facts.overlaps(F.col("text"), F.col("text"))).collect()
            best = min(best, time.time() - began)
        return best

    seconds(1000)
    assert seconds(64_000) < 2.8 * seconds(32_000) + 1


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(facts, "MOST_BITS", 64 * facts.PARTS)
    docs = spark.createDataFrame([(i, " ".join(f"d{i}w{j}" for j in range(40))) for i in range(80)], "id long, text string")
    assert facts.verbatim(docs, docs.filter("id % 2 = 0")).count() == 40


# --- streams


def clicks(spark, rows):
    return spark.createDataFrame(rows, "k string, at string, n long").withColumn("at", F.col("at").cast("timestamp"))


def plain_firsts(rows):
    """(k, at, n) of rows whose key wasn't seen in the six cycles before."""
    import datetime as dt

    cycle = lambda at: int(dt.datetime.fromisoformat(at + "+00:00").timestamp()) // 21600
    least = {}
    for k, at, n in rows:
        if at is not None:
            key = (k, cycle(at))
            least[key] = min(least.get(key, (at, n)), (at, n))
    out, last = [], {}
    for (k, c), (at, n) in sorted(least.items(), key=lambda x: x[0][1]):
        if k not in last or c - last[k] > 6:
            out.append((k, at, n))
        last[k] = c
    return sorted(out, key=repr)


def test_first_sightings_over_two_passes(spark, tmp_path):
    r = random.Random(11)
    rows = []
    for n in range(3000):
        hour = r.randrange(24 * 20)
        key = "hot" if r.random() < 0.33 else None if r.random() < 0.05 else f"k{r.randrange(60)}"
        rows.append((key, f"2024-01-{1 + hour // 24:02d} {hour % 24:02d}:{r.randrange(60):02d}:00", n))
    rows += [("null time", None, 1)] + rows[:50]
    rows.sort(key=lambda x: x[1] or "")
    show = lambda df: sorted(((x["k"], str(x["at"]), x["n"]) for x in df.collect()), key=repr)
    want = plain_firsts(rows)
    assert show(firsts.first_sightings(clicks(spark, rows), ["k"], ["at", "n"], "at")) == want
    for lot in (rows[:1500], rows[1500:]):
        clicks(spark, lot).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k string, at timestamp, n long").parquet(str(tmp_path / "in"))
        q = firsts.stream_first_sightings(stream, ["k"], ["at", "n"], "at").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        q = q.outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    assert show(spark.read.parquet(str(tmp_path / "out"))) == want
    # a pass long after leaves no key of before in the state
    clicks(spark, [("late", "2024-03-01 00:00:00", 1)]).write.mode("append").parquet(str(tmp_path / "in"))
    clicks(spark, [("later", "2024-03-09 00:00:00", 1)]).write.mode("append").parquet(str(tmp_path / "in"))
    q = firsts.stream_first_sightings(spark.readStream.schema("k string, at timestamp, n long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), ["k"], ["at", "n"], "at").writeStream.format("parquet")
    q = q.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2


def test_many_keys_are_few_python_calls_and_keep_their_ids(spark, tmp_path):
    # keys of a bucket share a row of state; ids beyond 2^53 come out as they went in
    big = (1 << 60) + 1
    rows = [(f"k{n % 3000}", f"2024-01-{1 + d:02d} 0{n % 6}:00:00", big + n + d * 3000) for d in (0, 1, 4) for n in range(3000)]
    lots = [rows[:3000], rows[3000:]]
    for lot in lots:
        clicks(spark, lot).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k string, at timestamp, n long").parquet(str(tmp_path / "in"))
        q = firsts.stream_first_sightings(stream, ["k"], ["at", "n"], "at", buckets=8).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        q = q.outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 8
    got = sorted(((x["k"], str(x["at"]), x["n"]) for x in spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)
    assert got == plain_firsts(rows) and len(got) == 6000


def test_tasks_reduce_what_they_hold(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(firsts, "HELD", 10)
    rows = [(f"k{n % 40}", f"2024-01-01 {n % 24:02d}:00:00", n) for n in range(800)]
    clicks(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, at timestamp, n long").parquet(str(tmp_path / "in"))
    q = firsts.stream_first_sightings(stream, ["k"], ["at", "n"], "at").writeStream.format("memory").queryName("held").outputMode("append").option("checkpointLocation", str(tmp_path / "cp"))
    q.trigger(availableNow=True).start().awaitTermination()
    assert sorted((x["k"], str(x["at"]), x["n"]) for x in spark.table("held").collect()) == plain_firsts(rows)


def test_replayed_and_broken_batches_change_nothing(spark, tmp_path, monkeypatch):
    log = commits.CycleLog(spark, str(tmp_path / "log"))
    schema, rows = "n long", spark.createDataFrame([("2024-01-01T00", 1), ("2024-01-01T06", 2)], "cycle string, n long")
    show = lambda: sorted(tuple(r) for r in log.read(schema).select("cycle", "batch", "n").collect())
    assert show() == [] and log.write(rows, 0) and not log.write(rows, 0)
    want = [("2024-01-01T00", 0, 1), ("2024-01-01T06", 0, 2)]
    assert show() == want
    # a batch that stops before its record isn't there; written again it is, once
    path = log._path
    monkeypatch.setattr(log, "_path", lambda name: path(name) if not name.startswith("commits/.") else (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        log.write(rows, 1)
    monkeypatch.undo()
    assert show() == want and os.path.isdir(tmp_path / "log/parts/cycle=2024-01-01T00/batch=1")
    assert log.write(rows.limit(1), 1) and len(show()) == 3
    assert log.write(rows.limit(0), 2) and len(show()) == 3
    # a stream that starts anew on the same log gives its batches again
    clicks(spark, [("a", "2024-01-01 01:00:00", 1), ("b", "2024-01-01 07:00:00", 2)]).write.parquet(str(tmp_path / "in"))
    other = commits.CycleLog(spark, str(tmp_path / "other"))
    per = lambda df: df.groupBy(commits.cycle_id("at").alias("cycle")).agg(F.count("*").alias("n"))
    for k in range(3):
        commits.run_cycles(spark.readStream.schema("k string, at timestamp, n long").parquet(str(tmp_path / "in")), other, per, str(tmp_path / f"cp{k}"))
        assert sorted((r["cycle"], r["n"]) for r in other.read(schema).collect()) == [("2024-01-01T00", 1), ("2024-01-01T06", 1)]
