"""Same-story clustering: greedy leaders found in parallel rounds.

Greedy leader clustering in seed order makes leaders of the lexicographically first maximal independent set
of the similarity graph (Blelloch, Fineman, Shun, SPAA 2012), which takes a few rounds of joins. Similar
pairs come from an exact prefix join on tokens, rarest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import values as V
from ..functions.text import strings
from ..plans.staging import staged
from .dedup import numbered
from .skew import with_value


#: A token of more items than HOT is hot; parts of its join.
HOT, SALTS = 10_000, 64
#: Members of a class that meet those of another (or its own) as one row: two parts make PART * PART pairs, some of them more.
PART = 500


def seed_order(items: DataFrame) -> DataFrame:
    """Adds ord: by feed rank (null: 999), newest first, arrival; within the topic."""
    return numbered(items, ["topic"], [F.coalesce("feed_rank", F.lit(999)), F.desc("published_at"), "arrival"], "ord")


def token_classes(items: DataFrame) -> DataFrame:
    """topic, ord, tokens, class, size of items (topic, ord, tokens: distinct): class is the least ord of the items with the same tokens, size how many there are.

    Items without tokens resemble nothing and are classes of their own. Sets are compared as sorted arrays; counts are combined before the shuffle, and a set that
    very many items share is no task of its own.
    """
    items = items.select("topic", "ord", F.array_sort("tokens").alias("tokens"))
    rows = staged(items.filter(F.size("tokens") > 0), "token-sets")
    held = rows.groupBy("topic", "tokens").agg(F.min("ord").alias("class"), F.count("*").alias("n"))
    held = held.select("topic", "tokens", F.struct("class", F.col("n").alias("size")).alias("held"), "n")
    known = with_value(rows, held, ["topic", "tokens"], "held", rows.count(), F.col("ord").cast("long")).select("topic", "ord", "tokens", "held.class", "held.size")
    alone = items.filter(F.size("tokens") <= 0).select("topic", "ord", "tokens", F.col("ord").alias("class"), F.lit(1).cast("long").alias("size"))
    return known.unionByName(alone)


def representatives(classes: DataFrame) -> DataFrame:
    """One item of each class of `token_classes`: topic, ord, tokens, size."""
    return classes.filter("ord = class").select("topic", "ord", "tokens", "size")


def links(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``classes`` with links: how many other items each resembles, from the pairs between representatives (topic, i, j). No pair of items is made."""
    sizes = representatives(classes).select("topic", F.col("ord").alias("class"), "size")
    both = pairs.select("topic", F.col("i").alias("class"), F.col("j").alias("other")).union(pairs.select("topic", "j", "i"))
    near = both.join(sizes.select("topic", F.col("class").alias("other"), F.col("size").alias("more")).hint("merge"), ["topic", "other"]).groupBy("topic", "class").agg(F.sum("more").alias("more"))
    near = near.join(sizes.hint("merge"), ["topic", "class"]).select("topic", "class", F.struct("more").alias("near"), F.col("size").alias("n"))
    rows = with_value(classes, near, ["topic", "class"], "near", classes.count(), F.col("ord").cast("long"))
    of_its_own = F.when(F.size("tokens") > 0, F.col("size") - 1).otherwise(0)
    return rows.select("topic", "ord", "class", "size", (of_its_own + F.coalesce("near.more", F.lit(0))).cast("long").alias("links"))


def expanded(classes: DataFrame, pairs: DataFrame, important=V.IMPORTANT_TOKENS) -> DataFrame:
    """All pairs of items (as rows of `similar_pairs`) of ``classes`` (of `token_classes`), from the ``pairs`` between representatives: members resemble each other as these do.

    Members are dealt to parts of some PART, and parts, not items, are joined; each two of them become their pairs in a task of their own choosing, so a class that
    holds a third of all items is no single task. Time is linear in the number of pairs.
    """
    part = F.pmod(F.xxhash64("ord"), F.col("parts")).alias("part")
    parts = F.ceil(F.col("size") / PART)
    members = classes.filter(F.size("tokens") > 0).withColumn("parts", parts).groupBy("topic", "class", part).agg(F.collect_list("ord").alias("held"))
    members = staged(members, "class-parts")
    first = staged(representatives(classes).filter(F.size("tokens") > 0).select("topic", F.col("ord").alias("class"), "tokens", parts.alias("parts"), "size"), "class-heads")
    n = F.size("tokens").cast("long")
    weighted = F.size(F.array_intersect("tokens", strings(important))).cast("long")
    own = first.filter("size > 1").select("topic", F.col("class").alias("x"), F.col("class").alias("y"), n.alias("overlap"), weighted.alias("weighted"), ((n + 1.5 * weighted) / F.size("tokens")).alias("sim"), F.col("parts").alias("px"), F.col("parts").alias("py"))
    near = pairs.select("topic", F.col("i").alias("x"), F.col("j").alias("y"), "overlap", "weighted", "sim")
    for c in ("x", "y"):
        near = near.join(first.select("topic", F.col("class").alias(c), F.col("parts").alias(f"p{c}")).hint("merge"), ["topic", c])
    rows = own.unionByName(near)
    for c in ("x", "y"):
        rows = rows.withColumn(f"p{c}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"p{c}") - 1)))
    for c in ("x", "y"):
        rows = rows.join(members.select("topic", F.col("class").alias(c), F.col("part").alias(f"p{c}"), F.col("held").alias(f"h{c}")).hint("merge"), ["topic", c, f"p{c}"])
    rows = rows.repartition("topic", "x", "px", "y", "py").withColumn("a", F.explode("hx")).withColumn("b", F.explode("hy"))
    rows = rows.filter("x <> y or a < b")
    return rows.select("topic", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"), "overlap", "weighted", "sim")


def marks(tokens: Column) -> Column:
    """A bit of 64 for each token: a set lacks at least as many of another's tokens as it lacks bits."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda held, t: held.bitwiseOR(bit(t)))


def candidates(items: DataFrame, theta: float, important=V.IMPORTANT_TOKENS) -> DataFrame:
    """topic, i, j for i < j: all pairs with sim >= theta, and few others; items: topic, ord, tokens (distinct).

    sim = (overlap + 1.5 * important overlap) / smaller size: a shared token weighs 1, an important one 2.5. Of the smaller set's tokens, rarest first, those
    from which on all weigh theta * size or more hold a shared one: only these are joined, to all tokens of the larger set. What meets there is compared by
    64 bits of the sets in the same task (see `marks`). A token that more than HOT items of a topic have is joined in SALTS parts, by the larger sets' numbers.
    """
    weight = F.size("tokens") + 1.5 * F.size(F.array_intersect("tokens", strings(important)))
    needed = theta * F.size("tokens") - 1e-9
    items = items.filter(F.size("tokens") > 0)
    each = staged(items.select("topic", "ord", F.size("tokens").alias("n"), needed.alias("needed"), (weight - needed).alias("spare"), marks(F.col("tokens")).alias("marks"), F.explode("tokens").alias("token")), "tokens")
    df = each.groupBy("topic", "token").agg(F.count("*").alias("n")).withColumn("df", F.col("n"))
    ranked = with_value(each, df, ["topic", "token"], "df", each.count(), F.col("ord").cast("long"))
    onward = F.sum(F.when(F.col("token").isin(*important), 2.5).otherwise(1.0)).over(Window.partitionBy("topic", "ord").orderBy(F.desc("df"), F.desc("token")).rowsBetween(Window.unboundedPreceding, 0))
    prefix = ranked.withColumn("onward", onward).filter("onward >= needed")
    hot = F.col("df") > HOT
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    a = prefix.select("topic", "token", F.col("ord").alias("a"), F.col("n").alias("na"), "spare", F.col("marks").alias("ma"), F.explode(salts).alias("salt"))
    b = ranked.select("topic", "token", F.col("ord").alias("b"), F.col("n").alias("nb"), F.col("marks").alias("mb"), F.when(hot, F.pmod("ord", F.lit(SALTS)).cast("int")).otherwise(0).alias("salt"))
    found = a.join(b, ["topic", "token", "salt"]).filter("a <> b and (na < nb or (na = nb and a < b)) and bit_count(ma & ~mb) <= spare")
    return found.select("topic", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).distinct()


def similar_pairs(items: DataFrame, theta: float, important=V.IMPORTANT_TOKENS) -> DataFrame:
    """topic, i, j, overlap, weighted, sim for i < j with sim >= theta; items: topic, ord, tokens (distinct).

    The `candidates` are compared in full. Every pair is a row: give it the `representatives` of classes where items repeat.
    """
    items = items.filter(F.size("tokens") > 0).select("topic", "ord", "tokens")
    left = items.select("topic", F.col("ord").alias("i"), F.col("tokens").alias("ti"))
    right = items.select("topic", F.col("ord").alias("j"), F.col("tokens").alias("tj"))
    both = F.array_intersect("ti", "tj")
    rows = candidates(items, theta, important).join(left, ["topic", "i"]).join(right, ["topic", "j"]).withColumn("both", both)
    rows = rows.withColumn("overlap", F.size("both").cast("long")).withColumn("weighted", F.size(F.array_intersect("both", strings(important))).cast("long"))
    sim = (F.col("overlap") + 1.5 * F.col("weighted")) / F.least(F.size("ti"), F.size("tj"))
    return rows.withColumn("sim", sim).filter(F.col("sim") >= theta).select("topic", "i", "j", "overlap", "weighted", "sim")


def leaders(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """topic, ord, leader for every item: itself, or the first earlier leader it resembles."""
    edges = staged(pairs.select("topic", "i", "j"), "edges")
    # undecided vertices of the graph; all others lead themselves
    live = staged(edges.select("topic", F.col("i").alias("v")).union(edges.select("topic", "j")).distinct(), "live")
    left, chosen = edges, None
    while not live.isEmpty():
        # no undecided neighbour before them: leaders; whoever is next to one: members
        fresh = staged(live.join(left.select("topic", F.col("j").alias("v")).distinct(), ["topic", "v"], "left_anti"), "leaders")
        chosen = fresh if chosen is None else chosen.union(fresh)
        members = left.join(fresh.withColumnRenamed("v", "i"), ["topic", "i"], "left_semi").select("topic", F.col("j").alias("v")).distinct()
        gone = staged(members.union(fresh), "decided")
        live = staged(live.join(gone, ["topic", "v"], "left_anti"), "live")
        for end in ("i", "j"):
            left = left.join(gone.withColumnRenamed("v", end), ["topic", end], "left_anti")
        left = staged(left, "edges")
    if chosen is None:
        return items.select("topic", "ord", F.col("ord").alias("leader"))
    first = edges.join(chosen.withColumnRenamed("v", "i"), ["topic", "i"], "left_semi").groupBy("topic", "j").agg(F.min("i").alias("l"))
    first = first.join(chosen.select("topic", F.col("v").alias("j")), ["topic", "j"], "left_anti").withColumnRenamed("j", "ord")
    return items.select("topic", "ord").join(first, ["topic", "ord"], "left").select("topic", "ord", F.coalesce("l", "ord").alias("leader"))


def clustered(items: DataFrame, theta: float = V.THETA) -> DataFrame:
    """Items (topic, ord, tokens, ...) with leader, cluster number in creation order and cluster_id.

    Only the first item of each class of equal token sets takes part in the leader rounds: whatever it follows, the others follow, and if it leads, it leads them.
    """
    classes = staged(token_classes(items), "token-classes")
    first = representatives(classes)
    lead = leaders(first, similar_pairs(first, theta))
    led = classes.groupBy("topic", "class").agg(F.count("*").alias("n")).join(lead.withColumnRenamed("ord", "class").hint("merge"), ["topic", "class"])
    lead = staged(with_value(classes.select("topic", "ord", "class"), led, ["topic", "class"], "leader", classes.count(), F.col("ord").cast("long")).select("topic", "ord", "leader"), "led")
    heads = lead.groupBy("topic", "leader").agg(F.count("*").alias("held"))
    heads = numbered(heads, ["topic"], ["leader"], "number").select("topic", "leader", "number", F.col("held").alias("n"))
    lead = with_value(lead, heads, ["topic", "leader"], "number", lead.count(), F.col("ord").cast("long")).withColumnRenamed("number", "n")
    out = items.join(lead.hint("merge"), ["topic", "ord"])
    return out.withColumn("cluster_id", F.concat(F.lit("cluster-"), "topic", F.lit("-"), F.col("n").cast("string")))


def rollup(items: DataFrame) -> DataFrame:
    """One row a cluster: counts, span, tiers and members in order."""
    members = F.array_sort(F.collect_list(F.struct("ord", "id")))
    base = items.groupBy("topic", "cluster_id").agg(
        F.count("*").alias("members"), F.countDistinct("source").alias("source_count"), F.countDistinct("source_domain").alias("distinct_domains"),
        F.min("published_at").alias("earliest"), F.max("published_at").alias("latest"), F.transform(members, lambda m: m["id"]).alias("member_ids"),
        F.min_by("title", "ord").alias("headline"),
    )
    tiers = items.groupBy("topic", "cluster_id", "tier").count().groupBy("topic", "cluster_id")
    tiers = tiers.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tier", F.col("count").cast("int"))))).alias("tier_histogram"))
    return base.join(tiers, ["topic", "cluster_id"])


def projected(items: DataFrame) -> DataFrame:
    """Items with their cluster's distinct raw domains and members an hour of the cycle."""
    held = items.groupBy("topic", "cluster_id").agg(F.countDistinct("source_domain").alias("mentions"), (F.count("*") / F.lit(V.CYCLE_HOURS)).alias("velocity"))
    return items.join(held, ["topic", "cluster_id"])
