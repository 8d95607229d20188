"""Sharding by a hierarchical weighted hash tree, with DataFrame functions only.

A row descends the tree: it draws a number for every region, goes to the best, draws again among that region's racks, and
again among the rack's shards. A draw is minus the logarithm of a hash of key and node, divided by the node's weight, which
is the sum of the shards below it; the smallest draw wins, the first of equals. Nodes win in proportion to their weights, and a
weight that changes moves rows only from or to its own subtree, as no other draw changes.

``grown`` adds shards as regions of their own: no node that was there changes its weight, so every row stays or goes to the
new shard, whatever the size of the tree before.

Within its shard every row gets a slot, gapless from 0 in the order of hash bucket and key. Slots come from counts per bucket, so
a shard's rows are never sorted in one task; the counts, one row per shard and bucket, are a bounded broadcast.

Null keys are placed like an empty key. Equal keys share a shard; rows of one key spread over buckets by their other
columns, so only rows that are equal in all columns follow each other in one task, where they get different slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.llm.common import fresh, with_results

BUCKETS = 1024
#: Rows of the broadcast counts.
MOST_COUNTS = 1_000_000


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, region: int = 8, rack: int = 4, start: int = 16) -> list[Shard]:
    """A cluster of shards of equal weight: up to ``start`` of them, so many per region and per rack, then :func:`grown`.

    From ``start`` on, the tree with one more shard is therefore the grown tree.
    """
    nodes = [Shard(i // region, i % region // rack, i) for i in range(min(shards, start))]
    return grown(nodes, shards - start) if shards > start else nodes


def grown(nodes: list[Shard], shards: int = 1, weight: float = 1.0) -> list[Shard]:
    """The tree with further shards, each in a region of its own."""
    region, shard = max(n.region for n in nodes) + 1, max(n.shard for n in nodes) + 1
    return nodes + [Shard(region + i, 0, shard + i, weight) for i in range(shards)]


def draw(key: Column, node: Column, weight: Column) -> Column:
    """Minus the logarithm of a hash in (0, 1), over the weight: exponential, so that the smallest of several is fair."""
    word = F.substring(F.md5(F.concat(key, F.lit("/"), node).cast("binary")), 1, 13)  # 52 bits, exact as a double
    uniform = (F.conv(word, 16, 10).cast("double") + 0.5) / F.lit(2.0**52)
    return -F.log(uniform) / weight


def _children(nodes: list[Shard]) -> dict[str, dict[str, float]]:
    """Weights of the nodes below each node; nodes without weight are left out."""
    below: dict[str, dict[str, float]] = {}
    for n in nodes:
        for parent, child in (("", f"region {n.region}"), (f"region {n.region}", f"rack {n.region}.{n.rack}"), (f"rack {n.region}.{n.rack}", f"{n.shard}")):
            if n.weight > 0:
                siblings = below.setdefault(parent, {})
                siblings[child] = siblings.get(child, 0.0) + n.weight
    return below


def placed(key: Column, nodes: list[Shard]) -> Column:
    """The shard of a key, level by level; draws are only made below the node that has been reached."""
    if not any(n.weight > 0 for n in nodes) or any(n.weight < 0 for n in nodes):
        raise ValueError("shards need weights of 0 or more, and one above 0")
    if len({n.shard for n in nodes}) < len(nodes):
        raise ValueError("a shard stands in one place of the tree")
    key = F.coalesce(key.cast("string"), F.lit(""))
    entries = []
    for parent, below in _children(nodes).items():
        structs = [
            F.struct(F.lit(i).alias("place"), F.lit(child).alias("node"), F.lit(float(weight)).alias("weight"))
            for i, (child, weight) in enumerate(below.items())
        ]
        entries += [F.lit(parent), F.array(*structs)]
    below = F.create_map(*entries)  # folded into one constant
    node = F.lit("")
    for _ in range(3):
        drawn = F.transform(
            F.element_at(below, node),
            lambda c: F.struct(draw(key, c["node"], c["weight"]).alias("draw"), c["place"].alias("place"), c["node"].alias("node")),
        )
        node = F.array_min(drawn)["node"]
    return node.cast("int")


def assign(docs: DataFrame, nodes: list[Shard], id_col: str = "doc_id") -> DataFrame:
    """Docs with ``shard`` and ``grown_shard``, where the row goes once one more shard is there."""
    key = F.col(id_col)
    return with_results(docs, {"shard": placed(key, nodes), "grown_shard": placed(key, grown(nodes))})


def slots(docs: DataFrame, nodes: list[Shard], id_col: str = "doc_id") -> DataFrame:
    """:func:`assign` with ``slot``, a gapless number within the shard."""
    buckets = max(1, min(BUCKETS, MOST_COUNTS // len(nodes)))
    rows = assign(docs, nodes, id_col)
    bucket, ahead, of_shard, of_bucket = (fresh(rows, name) for name in ("bucket", "ahead", "of_shard", "of_bucket"))
    plain = [F.col(f"`{name}`") for name, kind in docs.dtypes if not kind.startswith("map")]
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64(*plain), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", bucket).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    counts = counts.select(F.col("shard").alias(of_shard), F.col(bucket).alias(of_bucket), earlier.alias(ahead))
    inside = Window.partitionBy("shard", bucket).orderBy(id_col, F.xxhash64(*plain))
    rows = with_results(rows, {"slot": F.row_number().over(inside).cast("long") - 1})
    here = (F.col("shard") == F.col(of_shard)) & (F.col(bucket) == F.col(of_bucket))
    rows = rows.join(F.broadcast(counts), here).withColumn("slot", F.col("slot") + F.col(ahead))
    return rows.drop(bucket, ahead, of_shard, of_bucket)
