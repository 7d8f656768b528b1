"""Sharding by a hierarchical weighted hash tree.

A key descends region, rack and shard levels.  At each node it takes the child with the
largest weighted draw ln(u) / weight, where u is a uniform hash of the key and the child's
own name, so a child wins in proportion to its weight and no draw depends on its siblings:
changing the weight of a subtree only moves keys into or out of that subtree.

A shard added later is a *lot* of its own in the top-level draw, with its own name and
weight, and leads straight to that shard wherever it is mounted.  No old draw changes, so
keys move only into the new shard.

Defined results: a null text counts as no bytes; a null key is a key like any other;
repeated rows get the same shard and different slots; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scribeflow.llm.common import stage, unit

#: Bytes that each row needs besides its text.
ROW_BYTES = 8


@dataclass(frozen=True)
class Node:
    """A region or a rack with its children, or a shard (``shard`` is its number)."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


@dataclass(frozen=True)
class Tree:
    regions: tuple[Node, ...]
    lots: tuple[Node, ...] = field(default=())

    def grown(self, weight: float = 1.0) -> "Tree":
        """The tree with one more shard."""
        n = len(leaves(self.regions)) + len(self.lots)
        return Tree(self.regions, (*self.lots, Node(f"lot{n}", shard=n, own_weight=weight)))


def leaves(nodes: tuple[Node, ...]) -> list[Node]:
    return [x for n in nodes for x in (leaves(n.children) if n.children else [n])]


def layout(regions: int = 3, racks: int = 2, shards: int = 4, weights: list[float] | None = None) -> Tree:
    """An even tree; ``weights`` gives each shard's weight in shard order."""
    number = iter(range(regions * racks * shards))

    def leaf(rack: str) -> Node:
        k = next(number)
        return Node(f"{rack}/s{k}", shard=k, own_weight=weights[k] if weights else 1.0)

    return Tree(tuple(
        Node(f"r{i}", tuple(
            Node(f"r{i}/k{j}", tuple(leaf(f"r{i}/k{j}") for _ in range(shards)))
            for j in range(racks)))
        for i in range(regions)))


def _choose(key: Column, nodes: tuple[Node, ...]) -> Column:
    """The shard below ``nodes``: the best draw at this level, then the same one level down."""
    if len(nodes) == 1:
        return F.lit(nodes[0].shard) if nodes[0].shard is not None else _choose(key, nodes[0].children)
    draws = [F.struct((F.log(unit(key, F.lit(n.name))) / F.lit(float(n.weight))).alias("draw"), F.lit(k).alias("k"))
             for k, n in enumerate(nodes)]
    best = F.greatest(*draws)["k"]
    out = None
    for k, n in enumerate(nodes):
        below = F.lit(n.shard) if n.shard is not None else _choose(key, n.children)
        out = F.when(best == k, below) if out is None else out.when(best == k, below)
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard number of ``key``; it depends on the key and the tree alone."""
    return _choose(key, (*tree.regions, *tree.lots)).cast("int")


def assign(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row.

    Slots number the rows of a shard from 0 in doc_id order.  The narrow rows are dealt out
    by ranges of (shard, doc_id) and written; each range then needs only the count of the
    rows of its shard in earlier ranges, so no task sees a whole shard.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    key = docs["doc_id"].cast("long")
    narrow = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, tree.grown()).alias("grown_shard"),
    )
    order = ["shard", "doc_id", "text_crc32", "size"]
    dealt = stage(narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")
    counts = dealt.groupBy("part", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part", "shard").orderBy("doc_id", "text_crc32", "size")
    return dealt.withColumn("place", F.row_number().over(inside)).join(bases, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("base") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard")
