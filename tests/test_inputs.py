"""Registered feed sources, robots rules and slots, address ranges, quarantine, the sharded artifact."""

import ipaddress
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from lodestream.operators import quarantine, ranges
from lodestream.plans import queries, queries_state, sink
from lodestream.sources import feed_source, landed, robots

NOW = "2024-03-01T12:34:56Z"

# --- the registered source


@pytest.fixture()
def feeds(tmp_path):
    for name, files in {"a.example.com": {"1.xml": queries.RSS, "x/2.xml": queries.ATOM}, "b.example.com": {"big.xml": "<rss>" + "x" * 1_600_000}, "bad.org": {"bad.xml": "no feed", ".hidden": "x", "_SUCCESS": ""}, "c.org": {}}.items():
        os.makedirs(tmp_path / f"domain={name}/x")
        for f, text in files.items():
            (tmp_path / f"domain={name}" / f).write_text(text)
    (tmp_path / "stray.xml").write_text(queries.RSS)
    return str(tmp_path)


def test_landed_feeds_as_a_format(spark, feeds):
    feed_source.register(spark)
    df = spark.read.format("landed_feeds").load(feeds)
    assert {(r["domain"], r["file"], r["ok"], r["error"]) for r in df.collect()} == {
        ("a.example.com", "1.xml", True, None), ("a.example.com", "x/2.xml", True, None), ("b.example.com", "big.xml", False, "body too large"), ("bad.org", "bad.xml", True, None),
    }
    assert [r["xml"] for r in df.filter("file = '1.xml'").collect()] == [queries.RSS]
    only = df.filter("domain in ('bad.org', 'c.org') and bytes < 100")
    assert [r["domain"] for r in only.collect()] == ["bad.org"]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "domain" not in plan[plan.index("Filter") :].split("\n")[0] if "Filter" in plan else True
    assert spark.read.format("landed_feeds").load(feeds + "/none").count() == 0
    assert spark.read.format("landed_feeds").option("partitionBytes", 1).load(feeds).rdd.getNumPartitions() == 4


def test_filters_choose_the_folders(feeds):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    r = feed_source.LandedReader({"path": feeds})
    other = GreaterThan(("bytes",), 1)
    assert list(r.pushFilters([StringStartsWith(("domain",), "b"), other, In(("domain",), ("bad.org", "a.example.com", None))])) == [other]
    assert [f.domain for f in r.listed()] == ["bad.org"]
    assert list(r.pushFilters([EqualTo(("domain",), "nobody")])) == [] and r.listed() == []
    files = [feed_source.Found("d", str(i), s) for i, s in enumerate((5, 5, 20, 1, 1))]
    assert [[f.size for f in p] for p in feed_source.planned(files, 10)] == [[5, 5], [20], [1, 1]] and feed_source.planned([], 10) == []


def sources_of(spark, rows):
    return spark.createDataFrame(rows, "topic string, domain string, label string, tier string, kind string, feed_url string, query string")


def test_a_strategy_gives_what_landed_files_give(spark, feeds, tmp_path_factory):
    now = F.lit(NOW).cast("timestamp")
    feed_source.register(spark)
    row = lambda d, kind="rss", url=None: ("ai", d, d, "news", kind, url or f"https://{d}/feed", "q")
    rows = [row("a.example.com"), row("b.example.com"), row("none.org"), row("bad.org"), row("x.org", "ftp")]
    items, states = feed_source.ingested(sources_of(spark, rows), {"rss": feed_source.Strategy("landed_feeds", {"path": feeds})}, now)
    assert {(r["domain"], r["error"]) for r in states.collect()} == {("a.example.com", None), ("b.example.com", "body too large"), ("none.org", "file not found"), ("bad.org", None), ("x.org", "unknown strategy")}
    flat = tmp_path_factory.mktemp("flat")
    (flat / "1.xml").write_text(queries.RSS)
    (flat / "2.xml").write_text(queries.ATOM)
    old = sources_of(spark, rows[:1]).withColumn("file", F.explode(F.array(F.lit("1.xml"), F.lit("2.xml"))))
    want, _ = landed.ingested(old, str(flat), now)
    show = lambda df: sorted((r["title"], r["url"], r["feed_rank"], r["source_domain"], r["summary_hint"]) for r in df.collect())
    assert show(items) == show(want) and len(show(items)) == 3


def one_feed():
    """A reader that a user brings; made here, so that workers get it by value."""

    class OneFeed(DataSource):
        @classmethod
        def name(cls):
            return "one_feed"

        def schema(self):
            return "domain string, file string, bytes long, ok boolean, error string, xml string" if self.options.get("whole", "yes") == "yes" else "domain string, xml string"

        def reader(self, schema):
            xml = self.options["xml"]

            class Reader(DataSourceReader):
                def read(self, partition):
                    yield ("u.org", "memory", len(xml), True, None, xml)

            return Reader()

    return OneFeed


def test_a_users_reader_is_a_strategy(spark):
    feed_source.register(spark, one_feed())
    rows = [("ai", "u.org", "U", "news", "own", "https://u.org/feed", "q")]
    mine = feed_source.Strategy("one_feed", {"xml": queries.ATOM})
    found = feed_source.read(spark, mine)
    assert found.columns == ["domain", "file", "bytes", "ok", "error", "xml"] and found.count() == 1
    items, states = feed_source.ingested(sources_of(spark, rows), {"own": mine}, F.lit(NOW).cast("timestamp"))
    assert states.first()["error"] == "unknown strategy"  # the dispatch knows the kinds that may be fetched
    items, states = feed_source.ingested(sources_of(spark, rows).withColumn("kind", F.lit("json")), {"json": mine}, F.lit(NOW).cast("timestamp"))
    assert [r["title"] for r in items.collect()] == ["Atom one"] and states.first()["ok"]
    with pytest.raises(ValueError, match="no column file"):
        feed_source.read(spark, feed_source.Strategy("one_feed", {"xml": "x", "whole": "no"}))


def test_search_providers_in_their_order(spark, tmp_path):
    feed_source.register(spark)
    for name, topics in {"one": {"ai": [queries.ATOM], "big": ["<rss>" + "x" * 1_600_000]}, "two": {"ai": [queries.RSS, queries.ATOM]}}.items():
        for topic, texts in topics.items():
            os.makedirs(tmp_path / name / f"domain={topic}")
            for i, t in enumerate(texts):
                (tmp_path / name / f"domain={topic}" / f"{i}.xml").write_text(t)
    providers = [feed_source.Strategy("landed_feeds", {"path": str(tmp_path / n)}) for n in ("one", "two", "none")]
    got = [(r["topic"], r["provider_ord"], r["ord"], r["url"]) for r in feed_source.searched(spark, providers, F.lit(NOW).cast("timestamp")).orderBy("provider_ord", "ord", "url").collect()]
    assert got == [("ai", 0, 0, "https://b.example.com/1"), ("ai", 1, 0, "https://a.example.com/1"), ("ai", 1, 0, "https://b.example.com/1"), ("ai", 1, 1, "https://a.example.com/2"), ("ai", 1, 2, "https://a.example.com/3")]
    assert feed_source.searched(spark, [], F.lit(NOW).cast("timestamp")).count() == 0


def test_a_cycle_from_landed_feeds(spark, feeds, tmp_path_factory, capsys):
    from lodestream.__main__ import main, number

    out = tmp_path_factory.mktemp("cli")
    entry = {"name": "A", "owner": "o", "category": "AI/ML", "tier": 1, "sourceType": "blog", "feedUrl": "https://a.example.com/feed", "type": "RSS", "verified": True}
    (out / "catalog.json").write_text(json.dumps([entry, entry | {"name": "B", "feedUrl": "https://b.example.com/feed"}]))
    (out / "robots.json").write_text(json.dumps({"host": "a.example.com", "text": "User-agent: *\nDisallow: /2\nCrawl-delay: 3"}) + "\n")
    common = ["--feeds", feeds, "--catalog", str(out / "catalog.json"), "--now", NOW, "--floor", "0", "--robots", str(out / "robots.json"), "--slots", str(out / "slots"), "--concurrency", "nan"]
    assert main([*common, "--out", str(out / "a.json"), "--run-id", "mine", "--provider", "other", "--etl", "--etl-budget", "0"]) == 0
    body = json.loads((out / "a.json").read_text())
    assert body["runId"] == "mine" and [i["url"] for t, rows in body["data"]["itemsByTopic"].items() if t == "ai" for i in rows] and "facts by rules" in capsys.readouterr().err
    assert {i["title"] for i in body["data"]["itemsByTopic"]["all"]} == {"First story", "Second", "Atom one"} and not body["data"]["factsByCluster"]
    slots = [json.loads(x) for f in os.listdir(out / "slots") if f.endswith(".json") for x in (out / "slots" / f).read_text().splitlines()]
    assert sorted((s["url"], s["end_ms"] - s["start_ms"]) for s in slots) == [("https://a.example.com/1", 3000), ("https://b.example.com/1", 1000)]
    assert main([*common, "--shards", str(out / "shards"), "--max-age-hours", "1"]) == 0
    assert {json.loads(r["value"])["title"] for r in sink.read(spark, str(out / "shards")).filter("section = 'items'").collect()} == {"Second"}
    assert main(["--json-errors", "--now", NOW]) == 2 and json.loads(capsys.readouterr().out)["error"]["code"] == "INVALID_ARGUMENT"
    assert [number(7)(x) for x in ("0", "nan", "x", "inf", "2.5")] == [0, 7, 7, 7, 2.5]


# --- robots


def test_rules_equal_the_line_machine(spark):
    r = random.Random(4)
    bits = ["User-agent: *", "user-agent : lodestream", "User-Agent: other", "Disallow: /a", "Allow: /a/b # why", "disallow:", "Disallow: /x:y", "Crawl-delay: 2.5", "crawl-delay: 0", "Crawl-delay: soon", "", "   ", "# note", "nonsense", "Allow:/", "\tDisallow:\t/t\t", "User-agent", "\xa0", "Crawl-delay: .5", "Sitemap: https://a/b"]
    texts = [r.choice(["\n", "\r\n"]).join(r.choices(bits, k=r.randint(0, 14))) for _ in range(400)] + ["", "User-agent: *\n" + "Disallow: /p\n" * 30_000, "\n\nUser-agent: *\nDisallow: /z\n"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)] + [("null", None)], "host string, text string")
    got = {}
    for x in robots.rules(df).collect():
        got.setdefault(x["host"], []).append((x["kind"], x["prefix"], x["delay"]))
    for i, t in enumerate(texts):
        assert got.get(str(i), []) == robots.parse(t), repr(t[:300])
    assert "null" not in got


def test_longest_prefix_on_a_hot_host(spark):
    r = random.Random(6)
    rules = [(h, k, "/" + "/".join(r.choices("abc", k=r.randint(0, 3)))) for h in ("hot.org", "b.org", "c.org") for k in r.choices(["allow", "disallow"], k=12)]
    urls = [(i, "hot.org" if r.random() < 0.4 else r.choice(["b.org", "c.org", "free.org", None]), "/" + "/".join(r.choices("abcd", k=r.randint(0, 4)))) for i in range(6000)] + [(1, "hot.org", "/a")] * 2 + [(7, "b.org", None)]

    def plain(host, path):
        best = max(((len(p), k == "disallow") for h, k, p in rules if h == host and path is not None and path.startswith(p)), default=(0, False))
        return not best[1]

    df = spark.createDataFrame([(*x, None) for x in rules], "host string, kind string, prefix string, delay double")
    got = robots.allowed(spark.createDataFrame(urls, "id long, host string, path string"), df).collect()
    assert len(got) == len(urls) and all(x["allowed"] == plain(x["host"], x["path"]) for x in got)
    assert 500 < sum(x["allowed"] for x in got) < 5900


def test_slots_keep_their_distance(spark):
    urls = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot.org").when(F.col("id") % 101 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("h"), (F.col("id") % 40).cast("string"))).alias("host"), "id")
    ruled = spark.createDataFrame([("hot.org", "delay", "", 0.25), ("h1", "delay", "", 1e9), ("h1", "allow", "/", None)], "host string, kind string, prefix string, delay double")
    got = [x for x in robots.fetch_slots(urls.filter("host is not null"), ruled, ["id"], 4).collect()]
    assert len(got) == urls.filter("host is not null").count()
    by_lane = {}
    for x in got:
        by_lane.setdefault(x["lane"], []).append((x["start_ms"], x["end_ms"], x["host"], x["id"]))
    assert len(by_lane) == 4
    for rows in by_lane.values():
        rows.sort()
        assert rows[0][0] == 0 and all(a[1] == b[0] for a, b in zip(rows, rows[1:]))  # one after another, without gaps
    hot = sorted((x["start_ms"], x["id"]) for x in got if x["host"] == "hot.org")
    assert [i for _, i in hot] == sorted(i for _, i in hot) and {b[0] - a[0] for a, b in zip(hot, hot[1:])} == {250}
    assert {x["end_ms"] - x["start_ms"] for x in got if x["host"] == "h1"} == {3_600_000}


# --- ranges


def test_few_networks_are_looked_up_without_a_shuffle_of_addresses(spark, monkeypatch):
    nets = spark.createDataFrame([(10 << 24, 8, "ten"), ((10 << 24) + (1 << 16), 16, "ten one"), (0, 0, "all"), (11 << 24, 8, None)], "network long, bits int, label string")
    ips = spark.createDataFrame([(1, (10 << 24) + 5), (2, (10 << 24) + (1 << 16) + 7), (3, 11 << 24), (4, None), (5, 2**32 - 1)], "id long, ip long")
    show = lambda df: sorted((x["id"], x["bits"], x["label"]) for x in df.collect())
    few = ranges.located(ips, nets)
    assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString() and few.columns == ["id", "ip", "bits", "label"]
    monkeypatch.setattr(ranges, "BROADCAST", 0)
    many = ranges.located(ips, nets)
    assert show(few) == show(many) == [(1, 8, "ten"), (2, 16, "ten one"), (3, 0, "all"), (4, None, None), (5, 0, "all")]
    assert few.schema == many.schema


def test_the_narrowest_network_holds_an_address(spark):
    r = random.Random(9)
    nets = [ipaddress.ip_network((r.getrandbits(32) >> (32 - b) << (32 - b), b)) for b in (0, 1, 8, 8, 12, 16, 24, 30, 32) for _ in range(3)]
    ips = [r.getrandbits(32) for _ in range(1500)] + [int(n.network_address) for n in nets] + [int(n.broadcast_address) for n in nets] + [int(nets[9].network_address)] * 1500 + [None]
    table = spark.createDataFrame([(int(n.network_address), n.prefixlen, str(n)) for n in nets] + [(int(nets[5].network_address), nets[5].prefixlen, "~")], "network long, bits int, label string")
    got = ranges.located(spark.createDataFrame([(i, ip, 0) for i, ip in enumerate(ips)], "id long, ip long, bits2 int"), table).collect()
    assert len(got) == len(ips)
    for x in got:
        held = [n for n in nets if x["ip"] is not None and ipaddress.ip_address(x["ip"]) in n]
        best = max(held, key=lambda n: n.prefixlen, default=None)
        assert x["bits"] == (best and best.prefixlen if best is not None else None) and (best is None or x["label"] == str(best))
    assert ranges.located(spark.createDataFrame([(1, 5)], "id long, ip long"), table.limit(0)).first()["label"] is None
    assert [x[0] for x in spark.createDataFrame([(0,), (2**32 - 1,), (3232235777,)], "ip long").select(ranges.dotted(F.col("ip"))).collect()] == ["0.0.0.0", "255.255.255.255", "192.168.1.1"]


# --- quarantine


def test_good_and_bad_rows_are_all_rows(spark):
    rows = ['{"k": 1}', '{"k": 1, "more": [1]}', '{"k": "1"}', '{"k": null}', "{}", "", "  ", None, "[1]", "7", '{"k": 1', "nonsense", '{"k": 1.5}', '{"k": 1}', '{"k": 9223372036854775808}']
    df = spark.createDataFrame(list(enumerate(rows)), "reason2 int, props string").withColumn("parsed2", F.lit(1))
    good, bad = quarantine.parted(df, "props", "k long", ("k",))
    assert [r["parsed"]["k"] for r in good.orderBy("reason2").collect()] == [1, 1, 1]
    why = {r["reason2"]: r["reason"] for r in bad.collect()}
    assert why == {2: "wrong type", 3: "missing: k", 4: "missing: k", 5: "empty", 6: "empty", 7: "empty", 8: "not an object", 9: "not an object", 10: "not JSON", 11: "not JSON", 12: "wrong type", 14: "wrong type"}
    assert sorted(r["reason2"] for r in good.collect()) + sorted(why) == [0, 1, 13, *sorted(why)]
    assert quarantine.screened(df.limit(0), "props", "k long").count() == 0


# --- the sharded artifact


def test_small_shards_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).select(F.lit("items").alias("section"), F.lit("t").alias("topic"), F.col("id").alias("pos"), F.to_json(F.struct(F.col("id").alias("pos"))).alias("value"))
    sink.write(rows, str(tmp_path / "a"), 10)
    files = [f for _, _, names in os.walk(tmp_path / "a/lines") for f in names if f.startswith("part")]
    assert len(files) == 40 and len({f.split("-")[1] for f in files}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r["pos"] for r in sink.read(spark, str(tmp_path / "a")).collect()) == list(range(400))


def test_shards_are_ordered_and_checked(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("items").alias("section"), F.when(F.col("id") < 900, "hot").alias("topic"), F.when(F.col("id") < 900, F.col("id")).otherwise(F.col("id") - 900).alias("pos"))
    rows = rows.withColumn("value", F.to_json(F.struct("pos", F.lit("é\n|").alias("text"))))
    sink.write(rows.repartition(7), str(tmp_path / "a"), 64)
    manifest = {(m["topic"], m["shard"]): m for m in sink.read_manifest(spark, str(tmp_path / "a")).collect()}
    assert len(manifest) == 15 + 2 and manifest["hot", 14]["n"] == 900 - 14 * 64 and manifest["none", 1]["last"] == 99
    folder = tmp_path / "a/lines/section=items/topic=hot/shard=3"
    files = [f for f in os.listdir(folder) if f.startswith("part")]
    lines = [json.loads(x)["pos"] for x in (folder / files[0]).read_text().splitlines()]
    assert len(files) == 1 and lines == list(range(192, 256))
    assert sink.read(spark, str(tmp_path / "a")).count() == 1000
    (folder / files[0]).write_text((folder / files[0]).read_text().replace("192", "19"))
    for f in os.listdir(folder):
        if f.endswith(".crc"):
            os.remove(folder / f)
    with pytest.raises(Exception, match="broken shard"):
        sink.read(spark, str(tmp_path / "a")).count()
    sink.write(rows.limit(0), str(tmp_path / "b"))
    assert sink.read(spark, str(tmp_path / "b")).count() == 0


def test_page_feeds_are_landed_whole(spark, sf, tmp_path):
    queries_state.land_page_feeds(spark, sf, str(tmp_path / "f"))
    n = spark.read.format("landed_feeds").load(str(tmp_path / "f")).select(F.sum(F.size(F.split("xml", "<item>")) - 1)).first()[0] if feed_source.register(spark) is None else 0
    assert n == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_page_feeds_equal_their_sql_on_odd_pages(spark, tmp_path):
    """Feeds about as large as the bound, and pages whose titles, URLs, hosts or ids a feed file doesn't hold as they are."""
    import duckdb

    from lodestream.plans import oracle

    rows = []

    def add(url, title, page=0):
        rows.append((page if page is None else len(rows), url, None if title is None else f"<title>{title}</title>"))

    for over in range(-4, 5):  # bytes beyond the bound, by 88 an item and 48 a feed
        for n in (1, 3, 40):
            left = queries_state.FEED_MOST + over - 48 - 88 * n
            for i in range(n):
                url = f"https://b{over + 4}-{n}.example.com/{i:02d}"
                add(url, "t" * (left // n + (i < left % n) - len(url)))
    for host, title in [
        ("dash", "Headline - Some Paper"), ("own", "A - b - News source"), ("cut", "x <b>- y</b> z"), ("nul", "a\0b"), ("ctrl", "a\x01b\x0bc\x1f"), ("none", "a\ufffeb\uffff"), ("wide", "\u3000wide\u2003"), ("html", None),
    ]:
        for i, t in enumerate(("before", title, "after")):
            add(f"https://t-{host}.example.com/{i}", t)
    for i in range(40):  # pages without HTML have no bytes: just within the bound
        add(f"https://t-full.example.com/{i:02d}", None if i % 4 == 1 else "t" * (((6500 - 48) // 30 - 88) - 30))
    add("https://null.example.com/1", "no id", None)
    add("https://null.example.com/2", "an id")
    for end in ("\t", "\n", "\r", "\x0c", "\x0b", "\x01", "\0", "\u3000", " ", "#a\n", "#a\u2028", "|", "%7C"):
        add(f"https://u{len(rows)}.example.com/x{end}", "some end")
    for host in ("localhost", "10.0.0.1", "[::1]", "a b.example.com", "h(c):d.example.com", "h{a}.example.com", "中.example.com:x", "h\0.example.com", "l" * 300 + ".com", "www.", "..", "me@user.example.com", "p.example.com:443"):
        add(f"https://{host}/1", "some host")
    for i in range(40):
        add(f"https://intranet/{i}", "word " * 30)
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    columns = ["domain", "url", "title", "source_domain", "feed_rank", "error"]
    want = Counter(con.sql(f"select {', '.join(columns)} from ({oracle.ORACLE['feed_items']})").fetchall())
    got = Counter(tuple(r) for r in queries_state.feed_items(spark, str(tmp_path)).select(columns).collect())
    assert (got - want, want - got) == (Counter(), Counter())
    assert sum(r[5] is not None for r in want) == 3 * 4 + 1
