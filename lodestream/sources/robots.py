"""robots.txt as a rules table, the longest-prefix decision, and fetch slots that keep to it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import WS
from ..operators.dedup import numbered
from ..operators.skew import with_value
from ..plans.staging import staged

AGENT = "lodestream"
CHARS = 256_000
NUMBER = r"^[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
#: Seconds between two fetches from a host that asks for none; the most that is granted; fetches at once.
DELAY, LONGEST, LANES = 1.0, 3600.0, 10


def parse(text: str, agent: str = AGENT) -> list[tuple[str, str, float | None]]:
    """(kind, prefix, delay) rows line by line: the definition that `rules` keeps to. A blank line ends a group; of several agent lines in a row the last one counts."""
    strip = lambda x: x.strip("\t\n\x0b\x0c\r \xa0\ufeff")
    mine, out, delay = False, [], None
    for raw in text[:CHARS].replace("\r\n", "\n").split("\n"):
        line = strip(raw.partition("#")[0])
        field, colon, value = (strip(x) for x in line.partition(":"))
        field = field.lower()
        if not line:
            mine = False
        elif colon and field == "user-agent":
            mine = value.lower() in ("*", agent)
        elif mine and field in ("allow", "disallow") and value:
            out.append((field, value, None))
        elif mine and field == "crawl-delay":
            delay = float(value) if re.match(NUMBER, value) and float(value) > 0 else delay
    return out + ([("delay", "", delay)] if delay is not None else [])


def rules(robots: DataFrame, agent: str = AGENT) -> DataFrame:
    """host, kind, prefix, delay from host, text; column functions alone, within the row, in time linear in the text. A null text has no rules.

    Lines are brought into one form (field:value) and joined again; the text is then cut before each agent line and each blank line. A part belongs to whoever its
    first line names, so no state is carried from line to line.
    """
    trimmed = lambda c: F.regexp_replace(c, f"^{WS}+|{WS}+$", "")
    lines = F.split(F.replace(F.substring(F.coalesce("text", F.lit("")), 1, CHARS), F.lit("\r\n"), F.lit("\n")), "\n")

    def formed(raw: Column) -> Column:
        line = trimmed(F.substring_index(raw, "#", 1))
        field, value = F.lower(trimmed(F.substring_index(line, ":", 1))), trimmed(F.regexp_replace(line, "(?s)^[^:]*:", ""))
        return F.when(F.contains(line, F.lit(":")), F.concat(field, F.lit(":"), value)).when(line == "", "").otherwise("-")

    parts = F.split(F.array_join(F.transform(lines, formed), "\n"), "\n(?=\n|\\z|user-agent:)")
    mine = F.filter(parts, lambda p: F.lower(F.substring_index(p, "\n", 1)).isin("user-agent:*", f"user-agent:{agent}"))
    said = F.flatten(F.transform(mine, lambda p: F.split(p, "\n")))
    kind, value = lambda x: F.substring_index(x, ":", 1), lambda x: F.regexp_replace(x, "(?s)^[^:]*:", "")
    row = lambda kind, prefix, delay: F.struct(kind.alias("kind"), prefix.alias("prefix"), delay.cast("double").alias("delay"))
    ruled = F.transform(F.filter(said, lambda x: kind(x).isin("allow", "disallow") & (value(x) != "")), lambda x: row(kind(x), value(x), F.lit(None)))
    delays = F.filter(F.transform(F.filter(said, lambda x: (kind(x) == "crawl-delay") & value(x).rlike(NUMBER)), lambda x: value(x).cast("double")), lambda d: d > 0)
    delay = F.when(F.size(delays) > 0, F.array(row(F.lit("delay"), F.lit(""), F.element_at(delays, F.lit(-1))))).otherwise(F.array().cast("array<struct<kind:string,prefix:string,delay:double>>"))
    return robots.select("host", F.explode(F.concat(ruled, delay)).alias("r")).select("host", "r.*")


def allowed(urls: DataFrame, ruled: DataFrame) -> DataFrame:
    """urls (id, host, path) with allowed: the longest prefix decides, disallow wins ties, no rule allows; a host without rules is open.

    Prefixes are looked up, not compared: a path is cut to each length that its host's rules have, and (host, prefix) is an equal join. A host, or a prefix, that very
    many URLs share is in many tasks. Repeated rows are judged each.
    """
    r = staged(ruled.filter("kind in ('allow', 'disallow')").groupBy("host", "prefix").agg(F.max((F.col("kind") == "disallow").cast("int")).alias("no")), "robots-rules")
    rows = staged(urls.withColumn("_row", F.monotonically_increasing_id()), "robots-urls")
    lengths = r.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    lengths = rows.groupBy("host").agg(F.count("*").alias("n")).join(lengths.hint("merge"), "host")
    known = with_value(rows.select("_row", "host", "path"), lengths, ["host"], "lengths", rows.count(), F.col("_row"))
    cut = known.filter("lengths is not null").select("_row", "host", "path", F.explode("lengths").alias("k")).filter("k <= length(path)")
    cut = staged(cut.select("_row", "host", F.expr("substring(path, 1, k)").alias("prefix")), "robots-prefixes")
    held = cut.groupBy("host", "prefix").agg(F.count("*").alias("n")).join(r.hint("merge"), ["host", "prefix"])
    hit = with_value(cut, held, ["host", "prefix"], "no", cut.count(), F.col("_row")).filter("no is not null")
    best = hit.groupBy("_row").agg(F.max(F.struct(F.length("prefix").alias("k"), "no")).alias("m")).filter("m.no = 1").select("_row", F.lit(False).alias("open"))
    return rows.join(best.hint("merge"), "_row", "left").select(*urls.columns, F.coalesce("open", F.lit(True)).alias("allowed"))


def running_sum(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of their keys before them by ``order``; no key is one task.

    Rows are dealt by ranges and summed within each; only a sum for each range and key meets in one place.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, *order]
    dealt = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    dealt = staged(dealt.withColumn("_range", F.shiftright("_place", 33)), "running-sum")
    total = dealt.groupBy(*keys, "_range").agg(F.sum(value).alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum(value).over(Window.partitionBy(*keys, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.withColumn("_in", within).join(total.withColumn("_b", before).drop("_s"), [*keys, "_range"]).withColumn(name, F.col("_in") + F.col("_b")).drop("_place", "_range", "_in", "_b")


def fetch_slots(urls: DataFrame, ruled: DataFrame, order: list[str], lanes: int = LANES) -> DataFrame:
    """urls (host, ``order``, ...) with lane, start_ms and end_ms: when each may be fetched.

    A host's fetches are its crawl delay (DELAY, if it asks for none; LONGEST at most) apart and never overlap. A host has one of ``lanes`` lanes, by its hash, and a lane
    has one fetch at a time, so no more than ``lanes`` are in flight. Places among a host's URLs and hosts' places in a lane come from ranges and sums.
    """
    delay = ruled.filter("kind = 'delay'").groupBy("host").agg(F.max("delay").alias("delay"))
    placed = numbered(urls, ["host"], order, "_k")
    hosts = urls.groupBy("host").agg(F.count("*").alias("n")).join(delay.hint("merge"), "host", "left")
    ms = F.round(F.least(F.coalesce("delay", F.lit(DELAY)), F.lit(LONGEST)) * 1000).cast("long")
    hosts = hosts.select("host", "n", ms.alias("ms"), F.pmod(F.conv(F.substring(F.md5(F.coalesce("host", F.lit(""))), 1, 8), 16, 10).cast("long"), F.lit(lanes)).cast("int").alias("lane")).withColumn("span", F.col("n") * F.col("ms"))
    hosts = running_sum(hosts, ["lane"], ["host"], "span", "at").select("host", "n", F.struct("lane", "at", "ms").alias("slot"))
    rows = with_value(placed, hosts, ["host"], "slot", placed.count(), F.col("_k"))
    start = F.col("slot.at") + F.col("_k") * F.col("slot.ms")
    return rows.select(*urls.columns, F.col("slot.lane").alias("lane"), start.alias("start_ms"), (start + F.col("slot.ms")).alias("end_ms"))
