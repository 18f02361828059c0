"""Sharding by a weighted hash tree (regions, racks, shards).

A row descends the tree: at each node every child draws an exponential variate
from a hash of the row's key and the child's name, divided by the child's weight
(the number of shards below it); the smallest draw wins. A child's draw depends
on nothing but the key, its own name and its own weight, so a change of one
shard only moves rows into or out of the subtrees whose weights change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import table

#: Shards per rack, racks per region and shards of the first build of the fixed layout.
RACK, REGION, BASE = 4, 2, 16
#: Sub-ranges of a shard that are numbered side by side; the offsets table has shards x SLOT_RANGES rows.
SLOT_RANGES = 256
#: Equal rows numbered by one task at most.
RUN = 4096


@dataclass(frozen=True)
class Node:
    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int | None = None


def inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def layout(shards: int, base: int = BASE, rack: int = RACK, racks: int = REGION,
           weights: dict[int, float] | None = None) -> Node:
    """The tree of so many shards: a first build of whole racks and regions, then one region per added shard.

    A shard added later is a region of its own: only the root's list changes, so rows
    move into the new shard and nowhere else. ``weights`` gives shards another weight than 1.
    """
    leaf = lambda s: Node(f"s{s}", float((weights or {}).get(s, 1.0)), (), s)
    regions: list[Node] = []
    first = list(range(min(shards, base)))
    for r in range(0, len(first), rack * racks):
        part = first[r:r + rack * racks]
        regions.append(inner(f"g{r // (rack * racks)}", [
            inner(f"g{r // (rack * racks)}/k{k // rack}", [leaf(s) for s in part[k:k + rack]])
            for k in range(0, len(part), rack)]))
    regions += [inner(f"n{s}", [inner(f"n{s}/k0", [leaf(s)])]) for s in range(base, shards)]
    return inner("root", regions)


def draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight with u in (0, 1) from 53 bits of the hash of key and node name."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / F.lit(node.weight)


def descend(key: Column, node: Node) -> Column:
    """The shard that the key reaches from this node."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if len(live) == 1:
        return descend(key, live[0])
    # ties of draws go to the child that is listed first
    best = F.array_min(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    out = F.when(best == 0, descend(key, live[0]))
    for i, c in enumerate(live[1:], 1):
        out = out.when(best == i, descend(key, c))
    return out


def shard_rows(docs: DataFrame, tree: Node, grown: Node | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot[, grown_shard]`` of every row.

    A null key is a key like any other (all null keys meet in one shard); a null
    text has size 1 and the CRC of no bytes. Rows with one key share a shard. Slots
    number a shard's rows from 0 without gaps in the order of (sub-range, key, size,
    CRC). Equal rows are counted first and numbered in runs, so a key held by a third
    of all rows is no task of its own. An empty table gives an empty result.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("\0"))
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("_key"),
                       (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"))
    equal = rows.groupBy("doc_id", "_key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    equal = equal.withColumns({"shard": descend(F.col("_key"), tree),
                               "_range": F.pmod(F.xxhash64("_key", "size", "text_crc32"), F.lit(SLOT_RANGES)).cast("int")})
    offsets = equal.groupBy("shard", "_range").agg(F.sum("_n").alias("_in"))
    offsets = offsets.select("shard", "_range", F.expr(
        "sum(_in) OVER (PARTITION BY shard ORDER BY _range ROWS UNBOUNDED PRECEDING) - _in").alias("_before"))
    placed = equal.withColumn("_start", F.expr(
        "sum(_n) OVER (PARTITION BY shard, _range ORDER BY _key, size, text_crc32 ROWS UNBOUNDED PRECEDING) - _n"))
    placed = placed.join(offsets, ["shard", "_range"])
    runs = placed.withColumn("_run", F.explode(F.expr(f"sequence(0L, (_n - 1) div {RUN})")))
    runs = runs.withColumn("_one", F.when(F.col("_n") <= RUN, F.xxhash64("_key")).otherwise(F.xxhash64("_key", "_run")))
    slots = runs.repartition(F.col("_one")).withColumn("slot", F.explode(F.expr(
        f"sequence(_before + _start + _run * {RUN}L, _before + _start + least(_n, (_run + 1) * {RUN}L) - 1)")))
    out = [F.col("doc_id"), F.col("size"), F.col("text_crc32"), F.col("shard"), F.col("slot")]
    if grown is not None:
        out.append(descend(F.col("_key"), grown).alias("grown_shard"))
    return slots.select(*out)


def op5_weighted_hash_tree(spark, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards by the law ``key``: two regions of two racks of four shards.

    ``doc_id`` and the shard count alone decide (equal texts under different ids are
    not held together under this law); the seventeenth shard is a region of its own.
    """
    out = shard_rows(table(spark, sf_dir, "documents"), layout(16), layout(17))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                      F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                      F.col("grown_shard").cast("int").alias("grown_shard"))
