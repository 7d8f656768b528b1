"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scribeflow.llm.common import release, stage


#: Edges that one task links, in some hundred MB.
ONE_TASK = 500_000


def forest(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Of some edges, one from each node to the least node it reaches: the same components, with
    fewer edges and shorter ways."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in zip(left, right):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [(x, r) for x in list(parent) if (r := top(x)) != x]


def _forest(edges: DataFrame) -> DataFrame:
    """The forest of each partition's edges."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[int] = []
        right: list[int] = []
        for batch in batches:
            left += batch.column("a").to_pylist()
            right += batch.column("b").to_pylist()
            if len(left) > 1 << 20:
                left, right = (list(x) for x in zip(*forest(left, right)))
        found = forest(left, right)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(part, "a long, b long")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(near: DataFrame) -> DataFrame:
    """Every neighbour of a node, and the node, meet the least of them."""
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    met = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"), F.col("a").alias("u"))
    return met.select("a", "b", "u").union(least.select("a", F.col("m").alias("b"), F.col("a").alias("u")))


def components(edges: DataFrame, name: str = "components", one_task: int = ONE_TASK) -> DataFrame:
    """node, component (the least node reachable) for the nodes of ``edges`` (a, b: long).
    A round joins the edges twice with the nodes; what meets in a partition is linked there and then,
    and the rounds grow with the logarithm of the longest chain.  Up to ``one_task`` edges meet in
    one partition, which links them all."""
    now = stage(_forest(edges.where("a <> b")).distinct(), name)
    sign = None
    while True:
        if sign is None and now.count() <= one_task:
            before, now = now, stage(_forest(now.coalesce(1)), name)
            release(before)
            break
        large = _star(_both(now)).where("a > u and a <> b").select("a", "b")
        kept = large.union(_star(_both(now)).where("a = u and a <> b").select("a", "b")).distinct()
        small = _star(kept).where("a <> b").select("a", "b").distinct()
        before, now = now, stage(_forest(small), name)
        release(before)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == sign:
            break
        sign = tuple(new)
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
