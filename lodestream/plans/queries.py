"""Registry of the engine's own queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text, urls
from ..functions import values as V
from ..operators import cluster, dedup, extract, facts, metrics, ranges, store
from ..sources import catalog, feeds, robots
from ..streaming import cycles
from . import cycle, etl, staging

FLOOR = 20
NOW = "2024-03-01T12:34:56Z"
# Rows that the tables lack, for both engines.
URLS = (
    "https://user@a.example.com/x", "https://127.0.0.1/", "https://10.1.2.3/a", "http://b.example.org/p?q=1#f", "https://c.example.com:8080/x", "https://c.example.com:443/x/#y",
    "https://localhost/", "https://news.bbc.co.uk/a", "https://blog.shop.com.cn/", "https://x.y.co.kr/z/", "nonsense", "", "https://WWW.Example.COM/Path/", "https://[::1]/", "https://2130706433/",
)
HOSTS = (
    "localhost", "example.com", "10.0.0.1", "172.15.255.255", "172.16.0.1", "172.32.0.1", "192.168.1.1", "100.64.0.1", "100.63.0.1", "203.0.113.9", "8.8.8.8", "0x7f000001",
    "2130706433", "printer.local", "db.internal", "[::1]", "224.0.0.1", "255.255.255.255", "169.254.1.1",
)
PAGES = (
    ("p1", "wsj.com", "<html><body>" + "long text " * 40 + "</body></html>"), ("p2", "a.org", '<div class="paywall">' + "long text " * 40), ("p3", "a.org", "<p>short</p>"),
    ("p4", "a.org", '<script>{"isAccessibleForFree": "false"}</script>' + "long text " * 40), ("p5", "a.org", "<p>" + "open text " * 40 + "</p>"),
)
QUOTES = ("五个汉字吧", "two 汉字 words", "안녕하세요", "   ", "one two three", "w " * 26, "w " * 25, "ab漢cd かな")
ROBOTS = (
    ("thther.example.org", "User-agent: *\nDisallow: /en/\nAllow: /en/7\n\nUser-agent: other\nDisallow: /"),
    ("ththble.example.net", "User-agent: lodestream\nDisallow: /es/ # closed\nCrawl-delay: 2\n"),
)
MESSAGES = ("fetch failed", "Unexpected token <", "schemaVersion mismatch", "boom", "connect ETIMEDOUT", "JSON.parse: bad")
RSS = (
    '<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>'
    "<item><title>First story - Paper</title><link>https://a.example.com/1</link><pubDate>Fri, 01 Mar 2024 10:00:00 GMT</pubDate><description>Short</description>"
    "<content:encoded>" + "Body words here. " * 20 + '</content:encoded></item><item><title>Second</title><link>https://a.example.com/2</link><pubDate>bad</pubDate>'
    '<source url="https://s.example.com">Wire</source></item><item><title>Old</title><link>https://a.example.com/3</link><pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate></item></channel></rss>'
)
ATOM = (
    '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Atom one</title><link rel="self" href="https://b.example.com/self"/><link rel="alternate" href="https://b.example.com/1"/>'
    "<updated>2024-03-01T09:00:00Z</updated><summary>Sum</summary></entry></feed>"
)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _literal(spark: SparkSession, values, schema: str) -> DataFrame:
    return spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)


def _page_urls(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "pages").select("url").union(_literal(spark, URLS, "url string"))


def page_items(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as items: topic is the path's language, title the page's, arrival the page's number."""
    p = _t(spark, sf, "pages")
    h = urls.source_domain(F.col("url"))
    ts = F.timestamp_seconds(F.lit(1709294096) - F.col("page_id") * 600)
    return p.select(
        F.col("page_id").alias("arrival"), F.regexp_extract(urls.part(F.col("url"), 3), "^/([a-z]+)/", 1).alias("topic"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        "url", h.alias("source_domain"), h.alias("source"), F.when(F.col("page_id") % 3 == 0, "primary").otherwise("news").alias("tier"), ts.alias("published_at"),
        F.lit("").alias("summary_hint"), (F.col("page_id") % 7).cast("int").alias("feed_rank"),
    )


def doc_items(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as items: topic is the language, title the first twelve words, arrival the id."""
    words = F.split("text", r"[\t\n\x0B\f\r ]+")
    return _t(spark, sf, "documents").select(
        F.col("doc_id").alias("arrival"), F.col("lang").alias("topic"), F.array_join(F.slice(words, 1, 12), " ").alias("title"), F.col("source").alias("source"),
        F.concat("source", F.lit(".example.com")).alias("source_domain"), F.concat(F.lit("https://"), "source", F.lit(".example.com/a")).alias("url"), "text", "doc_id",
    )


def fact_docs(spark: SparkSession, sf: str) -> DataFrame:
    extra = _literal(spark, [(-1, "Microsoft said that Kubernetes clusters grew by 45 percent in the last year. After that the New York Times wrote about 1.5 million users there."), (-2, "revenue rose to 3,000 GB of data in the week. Nothing else of note was written in lower case words.")], "doc_id long, text string")
    docs = _t(spark, sf, "documents").select("doc_id", "text").union(extra)
    return docs.select(
        F.lit("ai").alias("topic"), F.concat(F.lit("cluster-ai-"), (F.pmod(F.col("doc_id"), F.lit(50))).cast("string")).alias("cluster_id"), F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit("s"), F.pmod(F.col("doc_id"), F.lit(3)).cast("string"), F.lit(".example.com")).alias("source_domain"), F.concat(F.lit("https://e.example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("body"),
    )


def strip_markup(spark, sf):
    c = text.strip_markup(F.col("text"))
    return _t(spark, sf, "documents").select("doc_id", F.length(c).cast("long").alias("n"), F.md5(c).alias("stripped_md5"), F.md5(text.normalize_title(F.col("text"))).alias("norm_md5"))


def fingerprint_ids(spark, sf):
    p = page_items(spark, sf).withColumn("fp", ids.fingerprint(F.col("title"), F.col("url")))
    return p.select(F.col("arrival").alias("page_id"), "fp", ids.item_id(F.col("topic"), F.col("fp")).alias("item_id"), ids.doc_id(F.col("url")).alias("doc_id"))


def split_title(spark, sf):
    d = doc_items(spark, sf).withColumn("t", F.concat("title", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" - "), "source")).otherwise("")))
    title, source = text.split_title(F.col("t"), F.when(F.col("doc_id") % 3 == 0, "Label"))
    return d.select("doc_id", title.alias("title"), source.alias("source_name"), text.truncate_hint(F.col("text")).alias("hint"))


def url_normalize(spark, sf):
    u = F.col("url")
    return _page_urls(spark, sf).select("url", urls.normalize_public_url(u).alias("https_only"), urls.normalize_public_url(u, True).alias("http_too"), urls.path_key(u).alias("path_key"), urls.source_domain(u).alias("domain"))


def owner_domains(spark, sf):
    h = F.col("h")
    return _page_urls(spark, sf).select(urls.host(F.col("url")).alias("h")).distinct().select("h", urls.registrable_domain(urls.owner_domain(h)).alias("owner_a"), urls.etld1(h).alias("owner_b"))


def blocked_hosts(spark, sf):
    """Hosts of all pages, and an address for each client."""
    ip = ranges.dotted(F.expr("pmod(client_id * 2654435761, 4294967296)"))
    hosts = _t(spark, sf, "pages").select(urls.host(F.col("url")).alias("h")).union(_t(spark, sf, "clients").select(ip)).union(_literal(spark, HOSTS, "h string"))
    return hosts.distinct().select("h", urls.blocked_host(F.col("h")).alias("blocked"))


def content_hash(spark, sf):
    return _t(spark, sf, "documents").groupBy(ids.content_hash(F.col("text")).alias("content_hash")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))


def html_text(spark, sf):
    t = text.html_text(F.col("html"))
    p = _t(spark, sf, "pages").withColumn("t", t)
    body = text.main_body(F.col("t"))
    return p.select("page_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("text_md5"), text.page_lang(F.col("html")).alias("lang"), text.space_words(body).alias("words"), F.when(text.space_words(body) > 50, "full").otherwise("snippet").alias("extraction"))


def paywall_flag(spark, sf):
    p = _t(spark, sf, "pages").select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("id"), urls.source_domain(F.col("url")).alias("domain"), "html")
    rows = p.union(_literal(spark, PAGES, "id string, domain string, html string"))
    return rows.select("id", text.paywalled(F.col("html"), F.col("domain")).alias("paywalled"))


def cjk_word_count(spark, sf):
    c = _t(spark, sf, "conversations").select("text").distinct().union(_literal(spark, QUOTES, "text string"))
    return c.select(F.md5("text").alias("k"), text.word_count(F.col("text")).alias("n"), text.space_words(F.col("text")).alias("n_space"), text.trim_quote(F.col("text")).alias("quote"))


def dedup_first_wins(spark, sf):
    d = _t(spark, sf, "documents").select(F.sha2("text", 256).alias("h"), "source", "doc_id", "lang")
    return dedup.first_wins(d, ["h", "source"], ["doc_id"]).select("h", "source", "doc_id", "lang")


def duplicates_removed(spark, sf):
    return dedup.duplicates_removed(_t(spark, sf, "documents").select(F.sha2("text", 256).alias("h")), ["h"])


def cycle_window_counts(spark, sf):
    e = cycles.cycle_counts(_t(spark, sf, "events"))
    return e.select(F.date_format("cycle_start", "yyyy-MM-dd HH:mm:ss").alias("cycle_start"), "event_type", "n", (F.col("n") / V.CYCLE_HOURS).alias("velocity"))


def metric_key_screen(spark, sf):
    extra = _literal(spark, ["userId", "user_id", "session_token", "share_count", "Like", "hearts", "e-mail address", "Comment Count", "count"], "key string")
    k = _t(spark, sf, "events").select(F.col("event_type").alias("key")).distinct().union(extra)
    return k.select("key", metrics.forbidden_key(F.col("key")).alias("forbidden"), metrics.metric_of(F.col("key")).alias("metric"))


def _coverage(spark, sf):
    items = doc_items(spark, sf)
    sources = items.groupBy("topic", "source").agg(F.count("*").alias("n")).select("topic", "source", (F.col("n") >= 3).alias("ok"))
    return sources, items


def topic_coverage(spark, sf):
    s, i = _coverage(spark, sf)
    return metrics.topic_coverage(s, i, FLOOR)


def global_coverage(spark, sf):
    s, i = _coverage(spark, sf)
    return metrics.global_coverage(metrics.topic_coverage(s, i, FLOOR), i)


def claims(spark, sf):
    terms = text.strings(("ere", "tion", "ment", "ci/cd", "ando"))
    return doc_items(spark, sf).select("doc_id", F.array_join(text.claims(F.col("title"), F.substring("text", 1, 250), terms), ",").alias("claims"))


def _tokened(spark, sf):
    return cluster.seed_order(page_items(spark, sf)).withColumn("tokens", text.title_tokens(F.col("title")))


def title_similarity_edges(spark, sf):
    """All pairs of pages with similar titles, copies among them; `title_classes` is the short form, with a row a page."""
    classes = staging.staged(cluster.token_classes(_tokened(spark, sf)), "token-classes")
    return cluster.expanded(classes, cluster.similar_pairs(cluster.representatives(classes), V.THETA))


def _clusters(spark, sf):
    items = page_items(spark, sf).withColumn("fp", ids.fingerprint(F.col("title"), F.col("url"))).withColumn("id", ids.item_id(F.col("topic"), F.col("fp")))
    return cluster.clustered(cluster.seed_order(items).withColumn("tokens", text.title_tokens(F.col("title"))))


def leader_clusters(spark, sf):
    return _clusters(spark, sf).select(F.col("arrival").alias("page_id"), "topic", "ord", "leader", "cluster_id")


def cluster_rollup(spark, sf):
    r = cluster.rollup(_clusters(spark, sf))
    hist = F.array_join(F.transform(F.map_entries("tier_histogram"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")
    return r.select("topic", "cluster_id", "members", "source_count", "distinct_domains", F.date_format("earliest", "yyyy-MM-dd HH:mm:ss").alias("earliest"), F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"), F.array_join("member_ids", ",").alias("member_ids"), hist.alias("tiers"))


def cluster_projection(spark, sf):
    return cluster.projected(_clusters(spark, sf)).select(F.col("arrival").alias("page_id"), "cluster_id", "mentions", "velocity")


def title_classes(spark, sf):
    """Pages in classes of equal title tokens, and how many other pages each resembles; `title_similarity_edges` has all pairs."""
    classes = cluster.token_classes(_tokened(spark, sf))
    return cluster.links(classes, cluster.similar_pairs(cluster.representatives(classes), V.THETA)).select("topic", "ord", "class", "size", "links")


def verbatim_overlap(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return facts.verbatim(d, _t(spark, sf, "benchmark")).select(F.col("id").alias("doc_id"))


def fact_rows(spark, sf):
    docs = fact_docs(spark, sf)
    f = facts.corroborated(facts.facts(docs), docs)
    return f.select("id", "cluster_id", "doc_id", "nth", "statement", F.array_join("entities", "|").alias("entities"), "quote", "metric", "value", "corroboration", "confidence")


def wire_guard(spark, sf):
    f = facts.facts(fact_docs(spark, sf))
    n = F.conv(F.substring("id", 1, 4), 16, 10).cast("int")
    f = f.withColumns({"provenance_count": F.when(n % 11 == 0, 0).otherwise(1), "verbatim": n % 7 == 0, "url": F.when(n % 5 == 0, "").otherwise(F.col("url")), "quote": F.when(n % 3 == 0, F.repeat(F.lit("w "), 26)).otherwise(F.col("quote"))})
    return facts.guarded(f).groupBy(F.coalesce("violation", F.lit("clean")).alias("violation")).agg(F.count("*").alias("n"))


def etl_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clustered pages as items, a store that knows some of them, and the landed pages: some from a search feed, some with a feed's body, some refused or missing."""
    n, known = F.col("arrival"), _clusters(spark, sf)
    said = F.repeat(F.concat("title", F.lit(" OpenAI said that it grew by 45 percent there. ")), (n % 12).cast("int"))
    items = known.withColumns(
        {
            "url": F.when(n % 11 == 0, F.concat(F.lit("https://news.google.com/rss/"), n.cast("string"))).otherwise(F.col("url")), "summary_hint": F.when(n % 22 == 0, F.repeat("title", 4)).otherwise(""),
            "feed_body": F.when(n % 3 == 1, said),
        }
    )
    pages = _t(spark, sf, "pages").select("page_id", "url", F.expr("if(page_id % 17 = 0, null, html)").alias("html"), (F.col("page_id") % 13 != 0).alias("allowed"))
    store = pages.filter("page_id % 7 = 0").select(
        ids.doc_id(F.col("url")).alias("id"), F.expr("if(page_id % 2 = 0, 'failed', 'full')").alias("extraction"), F.lit("allowed").alias("access_policy"), F.col("page_id").alias("word_count"), F.lit("en").alias("lang"),
        ids.content_hash(F.col("url")).alias("content_hash"), F.repeat(F.concat("url", F.lit(" Stored by Reader Two for 9 million. ")), 3).alias("body"),
    )
    return items, store, pages.drop("page_id")


def etl_documents(spark, sf):
    got = etl.run(*etl_inputs(spark, sf)).documents
    return got.select("topic", "cluster_id", "id", "url", "source_domain", "extraction", "access_policy", "word_count", "lang", "content_hash")


def etl_bodies(spark, sf):
    got = etl.run(*etl_inputs(spark, sf)).documents
    return got.select("cluster_id", "id", "origin", F.length("body").cast("long").alias("n"), F.md5("body").alias("body_md5"))


def etl_facts(spark, sf):
    f = etl.run(*etl_inputs(spark, sf)).facts
    return f.select("id", "topic", "cluster_id", "doc_id", "nth", "statement", F.array_join("entities", "|").alias("entities"), "quote", "metric", "value", "corroboration", "confidence")


def etl_guard(spark, sf):
    got = etl.run(*etl_inputs(spark, sf))
    f = got.screened
    # every third fact is put as a quotation of its own sentence, so that the guard meets real bodies
    lifted = F.when(F.conv(F.substring("id", 1, 4), 16, 10).cast("int") % 3 == 0, F.regexp_replace(F.col("quote"), "…$", "")).otherwise(F.col("statement"))
    bodies = dedup.first_wins(extract.eligible(got.documents), ["cluster_id", "id"], ["url", "content_hash"]).select("cluster_id", F.col("id").alias("doc_id"), "body")
    f = f.drop("violation", "verbatim").withColumn("statement", lifted).join(bodies, ["cluster_id", "doc_id"])
    return facts.guarded(f.withColumn("verbatim", facts.overlaps(F.col("statement"), F.col("body")))).select("id", "cluster_id", "doc_id", "violation")


def etl_warnings(spark, sf):
    return etl.run(*etl_inputs(spark, sf)).warnings.groupBy("topic", "cluster_id", "kind").agg(F.count("*").alias("n"))


def artifact_all(spark, sf):
    items = _clusters(spark, sf).withColumn("topic_ord", F.expr("cast(array_position(array('de', 'en', 'es', 'fr'), topic) as int)"))
    return cycle.all_items(cluster.projected(items)).select("pos", "id", "topic", "mentions", "cluster_id")


def fetch_budget(spark, sf):
    d = doc_items(spark, sf).select("topic", (F.col("doc_id") % 17).alias("cluster_ord"), F.col("doc_id").alias("member_ord"), F.sha2("text", 256).alias("url"))
    return dedup.fetch_budget(d, V.BUDGET).select("topic", "cluster_ord", "member_ord", F.col("nth").cast("long").alias("nth"))


def new_urls(spark, sf):
    p = _t(spark, sf, "pages")
    found = p.select("url", (F.col("page_id") % 2).alias("provider_ord"), F.col("page_id").alias("ord")).union(p.select("url", F.lit(5).cast("long"), F.col("page_id")))
    seen = p.filter(urls.part(F.col("url"), 3).startswith("/de/")).select(urls.normalize_public_url(F.col("url"), True).alias("url"))  # the German part is known
    return feeds.discovered(found, seen).select("url", F.col("provider_ord").cast("long").alias("provider_ord"), "ord", F.col("feed_rank").cast("long").alias("feed_rank"))


def new_domains(spark, sf):
    p = _t(spark, sf, "pages").select(urls.source_domain(F.col("url")).alias("domain"), urls.part(F.col("url"), 3).alias("path"))
    tier, cred = urls.domain_class(F.col("domain"))
    extra = _literal(spark, ["arxiv.org", "openai.com", "infoq.com", "threatpost.com", "www.arxiv.org"], "domain string")
    return p.select("domain").distinct().union(extra).join(p.filter(F.col("path").startswith("/es/")).select("domain").distinct(), "domain", "left_anti").select("domain", tier.alias("tier"), cred.alias("credibility"))


def global_merge_topk(spark, sf):
    d = doc_items(spark, sf)
    ord_ = F.expr("cast(array_position(array('de', 'en', 'es', 'fr'), topic) as bigint)")
    m = d.select(F.sha2("text", 256).alias("id"), "topic", (F.length("text") % 97).cast("long").alias("mentions"), ord_.alias("topic_ord"), F.col("doc_id").alias("item_ord"))
    return dedup.global_merge(m, 100).select("id", "mentions", "topic", "item_ord")


def robots_longest_prefix(spark, sf):
    u = _t(spark, sf, "pages").select(F.col("page_id").alias("id"), urls.host(F.col("url")).alias("host"), urls.part(F.col("url"), 3).alias("path"))
    return robots.allowed(u, robots.rules(_literal(spark, ROBOTS, "host string, text string"))).select(F.col("id").alias("page_id"), "host", "allowed")


CATALOG = (
    ("A", "o", "AI/ML", 1, "blog", "https://www.a.example.com/feed", "RSS", True, None), ("B", "o", "Security/Vulnerabilities", 2, "press", "https://b.example.com/feed", "Atom", None, None),
    ("C", "o", "DevOps", 2, "press", "https://c.example.com/feed", "RSS", True, None), ("D", "o", "Other", 3, "preprint", "https://d.example.com/feed", "RSS", True, None),
    ("E", "o", "AI/ML", 1, "blog", "http://e.example.com/feed", "RSS", True, None), ("F", "o", "AI/ML", 1, "blog", "https://f.example.com/api", "JSON", True, None),
    ("G", "o", "AI/ML", 2, "blog", "https://g.example.com/feed", "RSS", False, None), ("H", "o", "DevOps", 2, "blog", "https://h.example.com/feed", "RSS", True, None),
)


def catalog_topics(spark, sf):
    """Vendors as sources of a catalogue, beside entries of every kind written by hand."""
    n = F.col("vendor_id")
    pick = lambda values: F.get(text.strings(values), (n % len(values)).cast("int"))
    own = _t(spark, sf, "vendors").filter("vendor_id is not null").select(
        F.col("name"), F.lit("o").alias("owner"), pick(tuple(V.CATEGORY_TOPICS) + ("Other",)).alias("category"), (n % 3 + 1).cast("int").alias("tier"), pick(("blog", "press", "preprint", "press", "blog")).alias("sourceType"),
        F.concat(F.lit("https://www.v"), n.cast("string"), F.lit(".example.com/feed")).alias("feedUrl"), pick(("RSS", "Atom", "JSON", "RSS")).alias("type"), (n % 7 != 0).alias("verified"), F.lit(None).cast("string").alias("lastChecked"),
    )
    found = catalog.with_meta_feeds(catalog.sources(_literal(spark, CATALOG, catalog.SCHEMA).unionByName(own)), catalog.topics(spark))
    return catalog.by_topic(found).select("topic", "domain", "label", "tier", "kind", "credibility")


def error_codes(spark, sf):
    """Whatever the conversations say, and each raw time, as messages of errors."""
    said = _t(spark, sf, "conversations").select(F.col("text").alias("message")).union(_t(spark, sf, "stamps").select(F.concat(F.lit("parse of "), "raw"))).union(_literal(spark, MESSAGES, "message string"))
    said = said.filter("message is not null").distinct()
    return said.select(F.md5("message").alias("message_md5"), cycle.error_code(F.col("message")).alias("code"))


def store_upsert(spark, sf):
    d = _t(spark, sf, "documents")
    rows = d.select(ids.doc_id(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))).alias("id"), ids.content_hash(F.col("text")).alias("content_hash"), F.col("n_chars").alias("words"), F.col("doc_id").alias("arrival"))
    # every row is stored, put anew, or both; some are put twice
    old, new = rows.filter("arrival % 2 = 0"), rows.filter("arrival % 2 = 1 or arrival % 3 = 0").withColumn("words", F.col("words") + 1)
    again = rows.filter("arrival % 5 = 0").withColumns({"words": F.col("words") + 2, "arrival": F.col("arrival") + 1_000_000})
    return store.upsert(old, new.union(again))


def store_lookup(spark, sf):
    """Changes of clients as items against the clients as a store, by id; a client without a segment counts as one whose extraction failed."""
    ident = ids.doc_id(F.concat(F.lit("client/"), F.col("client_id").cast("string"))).alias("id")
    stored = _t(spark, sf, "clients").select(ident, F.when(F.col("segment").isNull(), "failed").otherwise("full").alias("extraction"))
    return store.looked_up(_t(spark, sf, "client_changes").select(ident, "change_id"), stored).select("change_id", "hit")


def store_by_hash(spark, sf):
    """All documents in a store whose index knows the last one of each text; every text is looked up."""
    d = _t(spark, sf, "documents").select(ids.doc_id(F.col("doc_id").cast("string")).alias("id"), ids.content_hash(F.col("text")).alias("content_hash"), "doc_id")
    index = store.current_index(d.withColumnRenamed("doc_id", "line"))
    return store.by_hash(d, index, d).select("id", "doc_id")


def store_freshness(spark, sf):
    e = _t(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("fetched"), F.expr("if(event_id % 3 = 0, null, 'e' || event_id % 7)").alias("etag"), F.expr("if(event_id % 5 = 0, null, 'e' || event_id % 4)").alias("known"))
    age = F.expr("if(event_id % 2 = 0, null, 5 * 86400000)").cast("long")
    fetched = F.when(F.col("event_id") % 11 != 0, F.col("fetched"))
    return e.select("event_id", store.fresh_enough(F.col("etag"), F.col("known"), fetched, F.lit(NOW).cast("timestamp"), age).alias("fresh"))


def interaction_metrics(spark, sf):
    e = _t(spark, sf, "events")
    entry = lambda key, value: F.struct(key.alias("key"), value.cast("double").alias("value"))
    entries = F.array(entry(F.lit("Share_Count"), F.col("user_id")), entry(F.col("event_type"), F.col("user_id") + 1), entry(F.lit("likes"), F.col("user_id") + 2), entry(F.lit("shares"), F.col("user_id") + 3), entry(F.lit("userId"), F.col("user_id")))
    return e.select("event_id", metrics.interaction(entries).alias("m")).select("event_id", "m.*")


def run_summary(spark, sf):
    return cycle.summary(_clusters(spark, sf))


def store_index(spark, sf):
    """What all documents add to an index that knows the English ones."""
    d = _t(spark, sf, "documents").select(ids.content_hash(F.col("text")).alias("content_hash"), F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("arrival"), "lang")
    old = store.current_index(d.filter("lang = 'en'").withColumnRenamed("arrival", "line"))
    return store.index_additions(old, d)


def _marked(c):
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def rss_parse(spark, sf):
    """A feed of one entry for each page, and feeds written by hand with old, undated and broken entries."""
    p = _t(spark, sf, "pages").select("page_id", "url", F.replace(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit(" - "), F.lit(" ")).alias("t"), urls.source_domain(F.col("url")).alias("domain"))
    entry = F.concat(F.lit("<feed><entry><title>"), _marked(F.col("t")), F.lit('</title><link href="'), _marked(F.col("url")), F.lit('"/><updated>2024-03-01T09:00:00Z</updated><summary>'), _marked(F.col("t")), F.lit("</summary></entry></feed>"))
    p = staging.staged(p.select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("source"), entry.alias("xml"), F.lit("ai").alias("topic"), F.lit(None).cast("string").alias("label"), "domain", F.lit("news").alias("tier")), "page-feeds")
    f = _literal(spark, [("rss1", RSS), ("atom1", ATOM), ("bad", "<html/>")], "source string, xml string")
    src = _literal(spark, [("rss1", "ai", "L", "a.example.com", "news"), ("atom1", "ai", "M", "b.example.com", "primary")], "source string, topic string, label string, domain string, tier string")
    found = staging.staged(feeds.entries(f.unionByName(p.select("source", "xml"))), "entries")
    return feeds.raw_items(found, src.unionByName(p.drop("xml")), F.lit(NOW).cast("timestamp")).withColumn("published_at", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"))


def artifact(spark, sf):
    items = cycle.aggregated(page_items(spark, sf), catalog.topics(spark))
    s = items.groupBy("topic", "source").agg(F.lit(True).alias("ok"))
    return cycle.artifact(spark, items, s, NOW, FLOOR)


def hermetic_artifact(spark, sf):
    return cycle.hermetic(spark, NOW)


def customers_without_orders(spark, sf):
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_nationkey")


def first_order_per_customer(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedup.first_wins(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


def supplier_coverage(spark, sf):
    li, o = _t(spark, sf, "lineitem"), _t(spark, sf, "orders")
    j = li.select("l_orderkey", "l_suppkey").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey")
    return j.groupBy("o_orderpriority").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.count("*").alias("lines"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        strip_markup, fingerprint_ids, split_title, url_normalize, owner_domains, blocked_hosts, content_hash, html_text, paywall_flag, cjk_word_count, dedup_first_wins, duplicates_removed,
        cycle_window_counts, metric_key_screen, topic_coverage, global_coverage, claims, title_similarity_edges, title_classes, leader_clusters, cluster_rollup, cluster_projection, verbatim_overlap, fact_rows,
        wire_guard, etl_documents, etl_bodies, etl_facts, etl_guard, etl_warnings, artifact_all, fetch_budget, new_urls, new_domains, global_merge_topk, robots_longest_prefix, catalog_topics, error_codes, store_upsert, store_lookup, store_by_hash, store_freshness, interaction_metrics, run_summary, store_index, rss_parse, artifact, hermetic_artifact,
        customers_without_orders, first_order_per_customer, supplier_coverage,
    )
}

from . import queries_state  # noqa: E402  reads this module's tables and helpers

QUERIES |= queries_state.QUERIES
