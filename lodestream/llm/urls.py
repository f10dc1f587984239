"""URL filters: rules first, then host word segmentation and multinomial naive Bayes.

Names in hosts are split into words by a unigram Viterbi. Word counts come from the pages' own text, paths
and hyphenated hosts; each distinct name fetches the counts of its substrings by a join, so no dictionary is broadcast.

The naive Bayes model is learned from the pages, as one learns from positive and unlabelled examples: unwanted are those that a rule
blocks and those whose host holds a seed word (a weak label, unless a rule allows the page); all others count as wanted. Its tokens are the
words of host and path, so words that stand beside blocked ones block as well, and a seed word in a company of wanted ones
need not. The token space is hashed to a fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import hot_join, staged

# The rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Words whose hosts count as unwanted among the examples.
SEEDS = ("ads", "adult", "bet", "bets", "bingo", "casino", "escort", "gambling", "loans", "lottery", "malware", "pharmacy", "phishing", "pills", "poker", "porn", "slots", "spam", "torrent", "tracker", "viagra", "warez", "xxx")
# Labels that say nothing about a host.
PLAIN = ("www", "com", "net", "org", "example", "m", "blog")
BUCKETS = 1 << 18
#: Letters of the longest word of the unigram model; octets of the longest name a host can have (RFC 1035): a longer one is no name and stays whole.
LONGEST_WORD, LONGEST_NAME = 24, 63
#: Substrings of up to so many letters (26 + 26^2 + 26^3 at most) are looked up in a broadcast table; each stands in too many names for a shuffle.
SHORT = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path: host after the first :// up to / ? # or the end, A-Z lower-cased; path up to ? or #."""
    part = lambda k: F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.translate(part(1), _UPPER, _LOWER).alias("host"), part(2).alias("path"))


def ruled(rules=RULES):
    """struct(rule, verdict) of the longest rule that fits host and path, else null."""
    out = None
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        hit = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n over the letters-only words of all pages' text, paths and hyphenated hosts; combined before the shuffle."""
    text = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ") if "html" in pages.columns else F.lit("")
    # a name counts as a word only where a hyphen parts it: else every concatenation would be one
    url = F.lower(F.coalesce("url", F.lit("")))
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    found = [F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0)), F.regexp_extract_all(path, F.lit("[a-z]+"), F.lit(0))]
    parted = F.regexp_extract_all(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("[a-z]+(?=-)|(?<=-)[a-z]+"), F.lit(0))
    words = F.concat(*found, parted)
    return pages.select(F.explode(words).alias("word")).filter(F.length("word") <= LONGEST_WORD).groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """Words of a name of letters: the cheapest path under unigram costs; an unseen word costs as if ten times rarer with each letter."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        ways = []
        for start in range(max(0, end - LONGEST_WORD), end):
            w = name[start:end]
            c = counts.get(w)
            cost = math.log(total) - math.log(c) if c else math.log(total) + len(w) * math.log(10)
            ways.append((best[start][0] + cost, start))
        best.append(min(ways))
    out, end = [], len(name)
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def _split(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            words = [split_name(n, dict(zip(w or [], c or [])), total) for n, w, c in zip(rows["name"], rows["words"], rows["counts"])]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], ["name", "split"])

    return run


def host_words(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """host, n, host_words for each distinct host: how many rows it has and the words of all its names, in order."""
    names = F.filter(F.split("host", r"[^a-z]+"), lambda x: (x != "") & ~x.isin(*PLAIN))
    hosts = staged(hosts.groupBy("host").agg(F.count("*").alias("n")).select("host", "n", names.alias("names")), "url-hosts")
    each = hosts.select(F.explode("names").alias("name")).distinct()
    total = counts.agg(F.sum("n")).first()[0] or 1
    parts = each.filter(F.length("name") <= LONGEST_NAME).select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("s"))
    size = F.explode(F.sequence(F.lit(1), F.least(F.length("name") - F.col("s") + 1, F.lit(LONGEST_WORD)))).alias("k")
    parts = parts.select("name", "s", size).select("name", F.expr("substring(name, s, k)").alias("word")).distinct()
    counts = counts.withColumnRenamed("n", "c")
    brief = parts.filter(F.length("word") <= SHORT).join(F.broadcast(counts.filter(F.length("word") <= SHORT)), "word")
    known = brief.unionByName(parts.filter(F.length("word") > SHORT).join(counts.filter(F.length("word") > SHORT), "word"))
    known = known.groupBy("name").agg(F.collect_list(F.struct("word", "c")).alias("p"))  # some LONGEST_NAME * LONGEST_WORD entries at most
    rows = each.join(known, "name", "left").select("name", F.col("p.word").alias("words"), F.col("p.c").alias("counts")).filter(F.length("name") <= LONGEST_NAME)
    split = rows.mapInArrow(_split(total), "name string, split array<string>")
    rows = hosts.select("host", "n", F.posexplode_outer("names").alias("i", "name")).join(split, "name", "left")
    words = F.coalesce("split", F.when(F.col("name").isNotNull(), F.array("name")), F.array().cast("array<string>"))
    rows = rows.groupBy("host").agg(F.any_value("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", words.alias("w")))).alias("p"))
    return staged(rows.select("host", "n", F.flatten("p.w").alias("host_words")), "url-split")


def with_host_words(rows: DataFrame, split: DataFrame) -> DataFrame:
    """``rows`` with the words of their hosts; hot hosts aren't shuffled."""
    total = split.agg(F.sum("n")).first()[0] or 0
    spread = F.concat(F.lit("/"), F.pmod(F.xxhash64("page_id", "path"), F.lit(4096)).cast("string"))  # no host has a slash
    return hot_join(rows, split, "host", "host_words", total, spread).withColumn("host_words", F.coalesce("host_words", F.array().cast("array<string>")))


def _odds(weights, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        for batch in batches:
            lists = batch.column("buckets")
            flat = table[lists.flatten().to_numpy(zero_copy_only=False)]
            sums = np.concatenate(([0.0], np.cumsum(flat)))
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            score = prior + sums[ends] - sums[np.concatenate(([0], ends[:-1]))] if len(ends) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("page_id", "host", "path", "host_words")], pa.array(score, pa.float64())], ["page_id", "host", "path", "host_words", "log_odds"])

    return run


def weights(counts: np.ndarray) -> np.ndarray:
    """Log odds of each bucket from its counts among unwanted and wanted pages (2 x buckets), with one added to each that any page has."""
    used = max(1, int((counts.sum(0) > 0).sum()))
    return np.log((counts[0] + 1) / (counts[0].sum() + used)) - np.log((counts[1] + 1) / (counts[1].sum() + used))


def judged(pages: DataFrame, *, held_out: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, host_words, log_odds for each row of ``pages`` (page_id, url; html if there).

    log_odds: of unwanted to wanted; where no rule fits the method blocks above 0. ``held_out`` (0 to 4): hosts whose hash leaves this
    remainder by 5 are not learned from, so that verdicts on them can be held against the rules'.
    A null or empty url, or one without ://, has an empty host and path and no rule. URLs without tokens get the
    prior's verdict. Urls and pages of any length are read whole. Two rules that fit one host and path differ in length, so ties can't
    occur. Repeated rows repeat theirs; an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    rows = parsed(pages)
    rows = with_host_words(rows, host_words(rows.select("host"), staged(word_counts(pages), "url-words")))
    path_words = F.regexp_extract_all(F.lower("path"), F.lit("[a-z]+"), F.lit(0))
    tokens = F.concat(F.transform("host_words", lambda w: F.concat(F.lit("h:"), w)), F.transform(path_words, lambda w: F.concat(F.lit("p:"), w)))
    bucket = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))
    seeded = F.arrays_overlap("host_words", F.array(*[F.lit(s) for s in SEEDS]))
    bad = F.coalesce(ruled()["verdict"] == "block", seeded)
    learn = F.lit(True) if held_out is None else F.pmod(F.xxhash64("host"), F.lit(5)) != held_out
    rows = staged(rows.withColumns({"buckets": bucket, "bad": bad, "learn": learn}), "url-rows")
    counts = np.zeros((2, BUCKETS))
    known = rows.filter("learn")
    for r in known.select("bad", F.explode("buckets").alias("b")).groupBy("b").agg(F.count_if("bad").alias("u"), F.count_if(~F.col("bad")).alias("w")).toLocalIterator():  # BUCKETS rows at most
        counts[:, r["b"]] = r["u"], r["w"]
    got = known.agg(F.count_if("bad"), F.count_if(~F.col("bad"))).first()
    prior = math.log((got[0] + 1) / (got[1] + 1))
    scored = rows.mapInArrow(_odds(spark.sparkContext.broadcast(weights(counts)), prior), "page_id long, host string, path string, host_words array<string>, log_odds double")
    rule = ruled()
    return scored.select(
        "page_id", "host", "path", rule["rule"].alias("rule"), F.coalesce(rule["verdict"], F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"),
        F.array_join("host_words", " ").alias("host_words"), "log_odds",
    )
