"""Operators against literal loops, and their invariants."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lodestream.functions import values as V
from lodestream.operators import cluster, dedup, facts, store
from lodestream.plans import cycle, queries
from lodestream.streaming import cycles


def greedy(sets, theta):
    """The literal loop over token sets in seed order."""
    heads, out = [], []
    for i, s in enumerate(sets):
        for h in heads:
            a = sets[h]
            both = s & a
            if s and a and (len(both) + 1.5 * len(both & set(V.IMPORTANT_TOKENS))) / min(len(s), len(a)) >= theta:
                out.append(h)
                break
        else:
            heads.append(i)
            out.append(i)
    return out


@pytest.mark.parametrize("theta", [0.5, 0.82])
def test_leaders_equal_the_literal_loop(spark, theta):
    r = random.Random(7)
    words = [f"w{i}" for i in range(12)] + ["kubernetes", "openai"]
    sets = [set(r.sample(words, r.randint(0, 5))) for _ in range(60)]
    items = spark.createDataFrame([("t", i, sorted(s)) for i, s in enumerate(sets)], "topic string, ord long, tokens array<string>")
    got = cluster.leaders(items, cluster.similar_pairs(items, theta)).orderBy("ord").collect()
    assert [g["leader"] for g in got] == greedy(sets, theta)


def test_histogram_sums_to_members(spark, sf):
    rows = cluster.rollup(queries._clusters(spark, sf)).collect()
    assert rows and all(sum(r["tier_histogram"].values()) == r["members"] == len(r["member_ids"]) for r in rows)


def test_first_wins_is_idempotent(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "x", 1), ("a", "y", 2), (None, "x", 5), (None, "x", 4)], "k string, d string, n int")
    once = dedup.first_wins(df, ["k", "d"], ["n"])
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, dedup.first_wins(once, ["k", "d"], ["n"]).collect()), key=repr)
    assert {r["n"] for r in once.collect()} == {1, 2, 4}


def test_budget_counts_a_url_once_a_cluster(spark):
    rows = [("t", 0, 0, "a"), ("t", 0, 1, "a"), ("t", 0, 2, "b"), ("t", 1, 0, "a"), ("t", 1, 1, "c")]
    got = dedup.fetch_budget(spark.createDataFrame(rows, "topic string, cluster_ord int, member_ord int, url string"), 3).orderBy("nth").collect()
    assert [(r["cluster_ord"], r["url"]) for r in got] == [(0, "a"), (0, "b"), (1, "a")]


def fact_docs(spark, domains):
    body = "OpenAI said that 45 percent of users in the Hong Kong office liked it. The new tool was bought by 3 million people in Spain."
    return spark.createDataFrame([("ai", "c1", f"d{i}", d, "https://x.example.com/", body) for i, d in enumerate(domains)], "topic string, cluster_id string, doc_id string, source_domain string, url string, body string")


def test_facts_and_corroboration(spark):
    docs = fact_docs(spark, ["blog.a.com", "news.a.com"])
    rows = facts.corroborated(facts.facts(docs), docs).collect()
    assert len(rows) == 4 and all(len(r["quote"].split()) <= 20 for r in rows)
    assert {(r["corroboration"], r["confidence"]) for r in rows} == {(1, "low")}
    first = next(r for r in rows if r["nth"] == 1)
    assert first["entities"] == ["OpenAI", "Hong Kong"] and first["value"] == 45.0 and first["metric"] == "OpenAI"
    docs = fact_docs(spark, ["a.com", "b.com"])
    assert {(r["corroboration"], r["confidence"]) for r in facts.corroborated(facts.facts(docs), docs).collect()} == {(2, "medium")}


def test_guard_records_the_first_violation(spark):
    rows = [(0, True, "", "q"), (1, True, "", "q"), (1, False, " ", "w " * 30), (1, False, "u", "w " * 26), (1, False, "u", "w " * 25), (None, None, None, None)]
    df = spark.createDataFrame(rows, "provenance_count int, verbatim boolean, url string, quote string")
    assert [r["violation"] for r in facts.guarded(df).collect()] == ["provenance", "verbatim", "url", "quote", None, "provenance"]


def test_store_rejects_unsafe_ids(spark):
    old = spark.createDataFrame([("a" * 40, 1)], "id string, n int")
    new = [("a" * 40, 2, 1), ("b" * 40, 3, 2), ("b" * 40, 4, 5), ("b" * 40, 9, 3)]
    assert {tuple(r) for r in store.upsert(old, spark.createDataFrame(new, "id string, n int, arrival int")).collect()} == {("a" * 40, 2), ("b" * 40, 4)}
    bad = spark.createDataFrame([("../etc/passwd", 2, 1)], "id string, n int, arrival int")
    for broken in (lambda: store.upsert(old, bad), lambda: store.body_of(bad, old.withColumn("body", F.lit("x")))):
        with pytest.raises(Exception, match="unsafe"):
            broken().collect()


def test_store_bodies_index_and_listing(spark):
    a, b = "a" * 40, "b" * 40
    bodies = spark.createDataFrame([(a, "old")], "id string, body string")
    puts = spark.createDataFrame([(a, None, 1), (b, "one", 2), (b, "two", 3)], "id string, body string, arrival int")
    assert {tuple(r) for r in store.bodies_upsert(bodies, puts).collect()} == {(a, "old"), (b, "two")}
    lines = spark.createDataFrame([('{"hash": "h1", "id": "%s"}' % a, 1), ("{broken", 2), ('{"hash": "h2"}', 3), ('{"hash": "h1", "id": "%s"}' % b, 4)], "value string, line int")
    index = store.current_index(store.read_index(lines))
    assert [tuple(r) for r in index.collect()] == [("h1", b)]
    stored = spark.createDataFrame([(a, "A"), (b, "B")], "id string, title string")
    wanted = spark.createDataFrame([("h1",), ("h9",), ("h1",)], "content_hash string")
    assert [tuple(r) for r in store.by_hash(wanted, index, stored).collect()] == [(b, "B")]
    assert [r["body"] for r in store.body_of(stored.filter("title = 'A'"), bodies).collect()] == ["old"] and [r["id"] for r in store.listing(stored).collect()] == [a, b]


def test_raising_forms(spark):
    from lodestream.functions import urls

    df = spark.createDataFrame([("https://a.example.com/x#f", "w " * 25)], "u string, q string")
    assert df.select(urls.checked_fetch_url(F.col("u"), F.array(F.lit("a.example.com"))), facts.checked_quote(F.col("q"))).first()[0] == "https://a.example.com/x"
    for c, match in ((urls.checked_fetch_url(F.lit("http://10.0.0.1/")), "unsafe URL"), (urls.checked_fetch_url(F.col("u"), F.array(F.lit("b.org"))), "unsafe URL"), (facts.checked_quote(F.lit("w " * 26)), "quote too long")):
        with pytest.raises(Exception, match=match):
            df.select(c).collect()


def test_numbers_equal_a_window(spark):
    from pyspark.sql.window import Window

    r = random.Random(5)
    rows = spark.createDataFrame([(r.choice("aab"), r.randint(0, 50), i) for i in range(700)], "k string, x int, i int")
    for n in ("3", "16"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = {x["i"]: x["ord"] for x in dedup.numbered(rows, ["k"], [F.desc("x"), "i"], "ord").collect()}
        spark.conf.set("spark.sql.shuffle.partitions", old)
        want = rows.withColumn("ord", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("x"), "i")) - 1)
        assert got == {x["i"]: x["ord"] for x in want.collect()}
    assert dedup.numbered(rows.filter("false"), ["k"], ["i"], "ord").count() == 0


def test_hot_tokens_are_joined_in_parts(spark, monkeypatch):
    r = random.Random(6)
    items = spark.createDataFrame([("t", i, ["common", *r.sample(["x", "y", "z", "w"], 2)]) for i in range(60)], "topic string, ord long, tokens array<string>")
    plain = {tuple(x) for x in cluster.similar_pairs(items, 0.6).collect()}
    monkeypatch.setattr(cluster, "HOT", 5)
    assert {tuple(x) for x in cluster.similar_pairs(items, 0.6).collect()} == plain and plain


def test_facts_of_another_extractor(spark):
    docs = spark.createDataFrame([("t", "c1", "d1", "a.com", "https://a.com/", "one two three four five six seven eight nine. " * 5), ("t", "c2", "d2", "b.com", "https://b.com/", "OpenAI said that sales rose by 45 percent in the year. " * 3), ("t", "c3", "d3", "b.com", "https://b.com/3", "x " * 80)], "topic string, cluster_id string, doc_id string, source_domain string, url string, body string")
    raw = [("c1", "d1", json.dumps({"facts": [{"statement": "A good statement", "quote": "w " * 26, "confidence": "high", "entities": ["", "E"], "quantity": {"metric": "m", "value": 2}}, {"statement": "short"}, {"statement": "one two three four five six seven eight"}]})), ("c2", "d2", "{broken"), ("c1", "gone", '{"facts": [{"statement": "No such document"}]}')]
    got, fallen = facts.chosen(docs, spark.createDataFrame(raw, "cluster_id string, doc_id string, raw string"))
    rows = facts.valid(facts.corroborated(got, docs)).collect()
    one = [x for x in rows if x["cluster_id"] == "c1"]
    assert len(one) == 1 and one[0]["quote"] is None and one[0]["entities"] == ["E"] and (one[0]["metric"], one[0]["value"], one[0]["confidence"]) == ("m", 2.0, "low") and all(x["schema_ok"] for x in rows)
    assert [x for x in rows if x["cluster_id"] == "c2"] and {(x["cluster_id"], x["reason"].partition(":")[0]) for x in fallen.collect()} == {("c2", "extractor returned no facts"), ("c3", "extractor unavailable")}
    assert {x["reason"] for x in facts.chosen(docs)[1].collect()} == {"extractor unavailable: facts by rules"}
    bad = facts.valid(got.withColumns({"corroboration": F.lit(0), "confidence": F.lit("sure")}))
    assert {x["violation"] for x in facts.guarded(bad.withColumns({"provenance_count": F.lit(1), "verbatim": F.lit(False)})).collect()} == {"schema"}


def test_artifact_is_reproducible_and_checked(spark, sf):
    a, b = (queries.artifact(spark, sf).first()["artifact"] for _ in range(2))
    assert a == b and cycle.checked(a) == []
    body = json.loads(a)
    listed = body["data"]["itemsByTopic"]
    ids = queries.fingerprint_ids(spark, sf).select("item_id").distinct().count()
    assert body["cycle"]["id"] == "2024-03-01T12:00:00.000Z" and sum(len(x) for t, x in listed.items() if t != "all") == ids == len(listed["all"])
    mentions = [x["mentions"] for x in listed["all"]]
    assert mentions == sorted(mentions, reverse=True) and len(body["data"]["clustersByTopic"]["all"]) == sum(len(x) for t, x in body["data"]["clustersByTopic"].items() if t != "all")
    assert not body["data"]["coverageByTopic"]["all"]["degraded"]
    with pytest.raises(ValueError):
        cycle.checked(json.dumps(body | {"schemaVersion": "other/v1"}))
    assert cycle.checked(json.dumps(body | {"contractRevision": 99})) == ["newer revision"]
    assert cycle.hermetic(spark, queries.NOW).first() == cycle.hermetic(spark, queries.NOW).first()


def test_feeds(spark, sf):
    rows = {r["title"]: r for r in queries.rss_parse(spark, sf).collect() if not r["source"].startswith("page")}
    assert set(rows) == {"First story", "Second", "Atom one"}  # the old one is past the age limit
    assert rows["First story"]["source_name"] == "Paper" and rows["First story"]["feed_body"].startswith("Body words") and rows["First story"]["feed_rank"] == 0
    assert rows["Second"]["source_name"] == "Wire" and rows["Atom one"]["url"] == "https://b.example.com/1"


def test_catalogue(spark, sf):
    rows = {(r["topic"], r["domain"]): r for r in queries.catalog_topics(spark, sf).collect()}
    assert rows["ai", "a.example.com"]["tier"] == "primary" and rows["security", "b.example.com"]["tier"] == "security-news" and rows["platform", "c.example.com"]["tier"] == "news"
    assert rows["platform", "d.example.com"]["tier"] == "paper" and rows["kubernetes", "h.example.com"]["tier"] == "technical-news" and ("ai", "e.example.com") not in rows
    assert sum(k[1] == "news.google.com" for k in rows) == 5


def test_stream_equals_batch(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "events.parquet").symlink_to(f"{sf}/events.parquet")
    stream = cycles.cycle_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    cycles.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    last = events.agg(F.max("ts")).first()[0]
    shown = lambda df: {tuple(r) for r in df.select(F.col("cycle_start").cast("string"), "event_type", "n").collect()}
    done = cycles.cycle_counts(events).filter(F.col("cycle_start") + F.expr("interval 6 hours") <= F.lit(last) - F.expr("interval 36 hours"))
    assert shown(spark.read.parquet(str(tmp_path / "out"))) == shown(done) and shown(done)
    # a row far behind the watermark is dropped; newer ones close the cycles that were open
    from datetime import timedelta

    fresh = events.limit(1).withColumn("ts", F.lit(last) + F.expr("interval 10 days")).union(events.limit(1).withColumn("ts", F.lit(last) - F.expr("interval 300 days")))
    fresh.coalesce(1).write.parquet(str(tmp_path / "more"))
    next((tmp_path / "more").glob("*.parquet")).rename(tmp_path / "in" / "late.parquet")
    for _ in range(2):
        cycles.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    whole = cycles.cycle_counts(events)
    assert shown(spark.read.parquet(str(tmp_path / "out"))) == shown(whole) and last - timedelta(days=1) < last


def test_documents_and_body_cascade(spark):
    from lodestream.operators import extract

    long = "<p>" + "open words here " * 40 + "</p>"
    pages = spark.createDataFrame(
        [("https://a.org/x?q=1", long, True), ("https://b.org/y?q=2", long, False), ("https://wsj.com/z", long, None), ("https://c.org/", None, True), ("https://d.org/p", "<p>short</p>", True)], "url string, html string, allowed boolean"
    )
    rows = {r["url"]: r for r in extract.documents(pages).collect()}
    assert rows["https://a.org/x?q=1"]["extraction"] == "full" and rows["https://a.org/x?q=1"]["access_policy"] == "allowed"
    assert rows["https://b.org/y"]["access_policy"] == "robots-disallowed" and rows["https://b.org/y"]["body"] is None
    assert rows["https://wsj.com/z"]["access_policy"] == "paywalled" and rows["https://wsj.com/z"]["extraction"] == "snippet" and rows["https://c.org/"]["extraction"] == "failed" and rows["https://d.org/p"]["access_policy"] == "paywalled"
    assert extract.eligible(extract.documents(pages)).count() == 1 and "body" not in extract.without_body(extract.documents(pages)).columns
    items = spark.createDataFrame(
        [(1, "u1", "a.org", "h", "f" * 300), (2, "u2", "a.org", "h", "f" * 300), (3, "u3", "news.google.com", "h" * 60, None), (4, "u4", "a.org", "h" * 60, None), (5, "u5", "a.org", "h", None)],
        "id int, url string, source_domain string, summary_hint string, feed_body string",
    )
    stored = spark.createDataFrame([("u1", "full", "stored"), ("u2", "failed", "x")], "url string, extraction string, body string")
    fetched = spark.createDataFrame([("u4", "got")], "url string, body string")
    got = extract.chosen_bodies(items, stored, fetched).orderBy("id").collect()
    assert [r["body_origin"] for r in got] == ["store", "feed", "hint", "fetch", "none"]


def test_a_failing_source_is_a_row(spark, tmp_path):
    from lodestream.sources import landed

    now = F.lit(queries.NOW).cast("timestamp")
    files = {"a.xml": queries.RSS, "big.xml": "<rss>" + "x" * 1_600_000, "news.xml": queries.RSS, "atom.xml": queries.ATOM, "bad.xml": "no feed"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "bytes.xml").write_bytes(b"<rss \xff\xfe")
    rss = lambda d, f, kind="rss", url=None, query="q": ("ai", d, d, "news", kind, url or f"https://{d}/feed", query, f)
    rows = [
        rss("a.example.com", "a.xml"), rss("b.example.com", "big.xml"), rss("c.example.com", "none.xml"), rss("news.google.com", "news.xml", "google-news-rss"), rss("news.google.com", "atom.xml", "google-news-rss", query=None),
        rss("d.example.com", "atom.xml", "json"), rss("e.example.com", "a.xml", url="https://10.0.0.1/feed"), rss("f.example.com", "a.xml", url="https://other.org/feed"), rss("g.example.com", "bad.xml"), rss("h.example.com", "bytes.xml"), rss("i.example.com", "a.xml", "ftp"),
    ]
    sources = spark.createDataFrame(rows, "topic string, domain string, label string, tier string, kind string, feed_url string, query string, file string")
    items, states = landed.ingested(sources, str(tmp_path), now)
    errors = {(x["domain"], x["kind"]): x["error"] for x in states.filter("not ok").collect()}
    assert errors == {("b.example.com", "rss"): "body too large", ("c.example.com", "rss"): "file not found", ("e.example.com", "rss"): "unsafe URL", ("f.example.com", "rss"): "unsafe URL", ("i.example.com", "ftp"): "unknown strategy"}
    assert states.count() == len(rows) and {x["source"].split("|")[1] for x in items.collect()} == {"a.example.com", "news.google.com", "d.example.com"}
    search = spark.createDataFrame([("ai", 0, True, queries.RSS), ("ai", 1, False, None), ("ai", 2, True, "broken")], "topic string, provider_ord int, ok boolean, xml string")
    found = landed.search_results(search, now).orderBy("ord").collect()
    assert [x["url"] for x in found] == ["https://a.example.com/1", "https://a.example.com/2", "https://a.example.com/3"] and found[1]["source_label"] == "Wire" and found[0]["domain"] == "a.example.com"


def test_articles_to_guarded_facts(spark, sf, tmp_path):
    from lodestream.plans import etl

    items, store_, pages = queries.etl_inputs(spark, sf)
    found = etl.run(items, store_, pages)
    assert "body" in found.documents.columns and not set(etl.PUBLIC) & {"body", "feed_body", "html"}
    kinds = {x["kind"] for x in found.warnings.collect()}
    assert {"provider", "empty", "fetch"} <= kinds <= {"budget", "search", "robots", "paywall", "fetch", "empty", "provider", "A5", "schema"}
    ready = cluster.projected(items.withColumns({"claims": F.array().cast("array<string>"), "topic_ord": F.lit(0)}))
    sources = ready.groupBy("topic", "source").agg(F.lit(True).alias("ok"))
    one = cycle.artifact(spark, ready, sources, queries.NOW, 0, found).first()["artifact"]
    body = json.loads(one)
    assert one == cycle.artifact(spark, ready, sources, queries.NOW, 0, found).first()["artifact"] and cycle.checked(one) == [] and body["upstreamRunId"] is None and {t["id"] for t in body["topics"]} >= {"all"}
    assert sum(map(len, body["data"]["documentsByTopic"].values())) == found.documents.count() and sum(map(len, body["data"]["factsByCluster"].values())) == found.facts.count() > 0
    assert len(body["warnings"]) == found.warnings.count() and not any("body" in d for ds in body["data"]["documentsByTopic"].values() for d in ds)
    # a fact that lifts eight words in a row of its document is dropped, recorded, and makes the run's exit code 1
    lifted = {"statement": "Stored by Reader Two for 9 million and so on", "confidence": "high"}
    row = found.documents.filter("origin = 'fetch' and extraction = 'full'").first()
    words = row["body"].split()
    raw = spark.createDataFrame([(row["cluster_id"], row["id"], json.dumps({"facts": [lifted, {"statement": " ".join(words[5:15])}]}))], "cluster_id string, doc_id string, raw string")
    got = etl.run(items, store_, pages, raw)
    assert [x["statement"] for x in got.facts.filter(F.col("cluster_id") == row["cluster_id"]).collect()] == [lifted["statement"]]
    assert cycle.exit_code(["[A5] x"]) == 1 and cycle.exit_code(["x"]) == 0
    # published runs replace each other whole
    for run, frame in (("r1", found.facts), ("r2", found.facts.limit(1))):
        cycle.publish({"facts": frame, "documents": found.documents.drop("body")}, str(tmp_path / "out"), run)
        assert cycle.published(spark, str(tmp_path / "out"), "facts").count() == frame.count()


def test_command_line(spark, sf, tmp_path, capsys):
    from lodestream.__main__ import main

    assert main(["--now", "yesterday", "--no-network"]) == 2 and "INVALID_ARGUMENT" in capsys.readouterr().err
    outs = [tmp_path / "a.json", tmp_path / "b.json"]
    assert [main(["--no-network", "--now", "2024-03-01T01:02:03Z", "--out", str(o)]) for o in outs] == [0, 0]
    assert outs[0].read_bytes() == outs[1].read_bytes()
    assert main(["--tables", sf, "--now", "2024-03-01T01:02:03Z", "--floor", "0", "--with-facts"]) == 0
    data = json.loads(capsys.readouterr().out)["data"]
    assert data["clustersByTopic"] and data["factsByCluster"] and data["documentsByTopic"]


def test_log_describe_and_catalogue_file(spark, sf, tmp_path):
    from lodestream.plans import etl
    from lodestream.sources import catalog

    states = spark.createDataFrame([("ai", "a.org", True, None), ("ai", "b.org", False, "file not found")], "topic string, domain string, ok boolean, error string")
    new = spark.createDataFrame([("ai", "c.org", "news", 0.6)], "topic string, domain string, tier string, credibility double")
    removed = spark.createDataFrame([("ai", 3), ("platform", 0)], "topic string, removed int")
    said = cycle.log(states, new, removed)
    want = ["[ai] 3 exact repeats removed", "[ai] new domain discovered: c.org (tier=news, credibility=0.6), for review", "[ai] source b.org: file not found"]
    assert sorted(x["message"] for x in said.collect()) == want
    items, store_, pages = queries.etl_inputs(spark, sf)
    found = etl.run(items, store_, pages)
    parts = json.loads(cycle.describe(items, found))
    assert set(parts) == {"items", "documents", "facts"} and "body" not in {f["name"] for f in parts["documents"]["fields"]}
    ready = cluster.projected(items.withColumns({"claims": F.array().cast("array<string>"), "topic_ord": F.lit(0)}))
    body = json.loads(cycle.artifact(spark, ready, ready.groupBy("topic", "source").agg(F.lit(True).alias("ok")), queries.NOW, 0, None, said).first()["artifact"])
    assert body["warnings"] == want
    names = [x.split()[0] for x in catalog.SCHEMA.split(", ")]
    (tmp_path / "catalog.json").write_text(json.dumps([dict(zip(names, row)) for row in queries.CATALOG]))
    read = catalog.read_catalog(spark, str(tmp_path / "catalog.json"))
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(queries.CATALOG, key=repr)


def test_word_lists_are_what_the_queries_were_checked_with():
    """Pins the fixed values that both sides of the comparison with SQL read."""
    assert {"userid", "sessionid"} <= {k for k in ("userid", "sessionid") if any(f in k for f in V.FORBIDDEN_FRAGMENTS)} and not any(f in "sharecount" for f in V.FORBIDDEN_FRAGMENTS)
    assert "likes" in V.METRICS["reactions"] and {"shares", "comments", "reactions"} == set(V.METRICS)
    classes = {d: t for t, _, ds in V.KNOWN_DOMAINS for d in ds}
    assert (classes["openai.com"], classes["arxiv.org"], classes["infoq.com"]) == ("primary", "paper", "technical-news")
    assert {"co.uk", "com.cn"} <= set(V.CORROBORATION_SUFFIXES) and [t[0] for t in V.TOPICS] == ["all", "ai", "models", "platform", "kubernetes", "security"]
    assert (V.QUOTE_WORDS, V.GRAM_WORDS, V.THETA, V.BUDGET, V.CYCLE_HOURS, V.MAX_AGE_HOURS, V.HINT_CHARS) == (25, 8, 0.82, 30, 6, 36, 250)
    assert {"wsj.com", "ft.com"} <= set(V.CLOSED_DOMAINS) and len(V.ORGANISATIONS) == 11 and len(V.UNITS) == 17
