"""Addresses in networks, by equal joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..plans.staging import staged
from .skew import with_value


#: So many networks are broadcast, some 100 bytes each.
BROADCAST = 500_000


def dotted(ip: Column) -> Column:
    """A 32-bit number as an IPv4 address."""
    return F.concat_ws(".", *[F.shiftright(ip, 24 - 8 * k).bitwiseAND(F.lit(255)) for k in range(4)])


def masked(ip: Column, bits: Column) -> Column:
    """The first ``bits`` of an address, as a number; of 0 bits 0."""
    return F.call_function("shiftright", ip, F.lit(32) - bits)


def private_networks(spark) -> DataFrame:
    """network, bits, label of the private and local ranges."""
    rows = [(sum(int(x) << (24 - 8 * i) for i, x in enumerate(base.split("."))), bits, f"{base}/{bits}") for base, bits in V.PRIVATE_RANGES]
    return spark.createDataFrame(rows, "network long, bits int, label string")


def located(addresses: DataFrame, networks: DataFrame, ip: str = "ip") -> DataFrame:
    """``addresses`` with bits and label of the narrowest of ``networks`` (network: a number, bits, label) that holds the address in ``ip``; null where none does.

    An address is masked to each length that the networks have (33 at most) and looked up, so nothing is compared by ranges. Of networks that are the same the least label
    counts. Null addresses are in no network. Networks are counted: up to BROADCAST of them, those of each length are sent to where the addresses are read, and no address
    is shuffled; more are met by a shuffle, in which a network that very many addresses share is in many tasks.
    """
    table = networks.groupBy(masked(F.col("network"), F.col("bits")).alias("_net"), F.col("bits").alias("_bits")).agg(F.min("label").alias("_label"))
    table = staged(table.filter("_net is not null and _bits is not null and _label is not null"), "networks")
    counts = table.groupBy("_bits").count().collect()  # 33 rows at most
    lengths = sorted(r["_bits"] for r in counts)
    found = _looked_up if sum(r["count"] for r in counts) <= BROADCAST else _shuffled
    mine = [F.col(f"`{c}`") for c in addresses.columns]
    return found(addresses, table, lengths, ip).select(*mine, F.col("_m._bits").alias("bits"), F.col("_m._label").alias("label"))


def _looked_up(addresses: DataFrame, table: DataFrame, lengths: list[int], ip: str) -> DataFrame:
    rows, none = addresses, F.lit(None).cast("struct<_bits: int, _label: string>")
    for b in lengths:  # a network of one length holds an address, or none does: rows stay one each
        own = table.filter(F.col("_bits") == b).select(F.col("_net").cast("long").alias(f"_net{b}"), F.struct("_bits", "_label").alias(f"_m{b}"))
        rows = rows.join(F.broadcast(own), masked(F.col(ip).cast("long"), F.lit(b)) == F.col(f"_net{b}"), "left").drop(f"_net{b}")
    return rows.withColumn("_m", F.coalesce(*[F.col(f"_m{b}") for b in reversed(lengths)], none))


def _shuffled(addresses: DataFrame, table: DataFrame, lengths: list[int], ip: str) -> DataFrame:
    rows = staged(addresses.withColumn("_row", F.monotonically_increasing_id()), "addresses")
    each = rows.select("_row", F.col(ip).alias("_ip"), F.explode(F.array(*[F.lit(b) for b in lengths]) if lengths else F.array().cast("array<int>")).alias("_bits"))
    each = staged(each.select("_row", "_bits", masked(F.col("_ip"), F.col("_bits")).alias("_net")), "masked-addresses")
    held = each.groupBy("_net", "_bits").agg(F.count("*").alias("n")).join(table.hint("merge"), ["_net", "_bits"])
    hit = with_value(each, held, ["_net", "_bits"], "_label", each.count(), F.col("_row")).filter("_label is not null")
    best = hit.groupBy("_row").agg(F.max(F.struct("_bits", "_label")).alias("_m"))
    return rows.join(best.hint("merge"), "_row", "left")
