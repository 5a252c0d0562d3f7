"""Distributed union-find: connected components of an edge table.

Each partition first runs union-find over its own edges and hands on a
spanning forest, so that later rounds move at most one edge per node and
partition. Then alternating large-star and small-star rounds (joins and
minimum aggregations, each written to the shared folder) contract the rest:
every node ends up linked to the smallest node of its component, in a number
of rounds that grows with the logarithm of the component size. Nothing is
collected to the driver but the count and checksum of a round's edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import discard, stored

MAX_ROUNDS = 60


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in parent]
    pairs = [(x, r) for x, r in pairs if x != r]
    for lo in range(0, len(pairs), 100_000):
        part = pairs[lo : lo + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], ["a", "b"]
        )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Label the nodes of ``edges`` (two bigint columns) with their component's smallest node.

    Returns ``node, component`` for every node that has an edge to another
    node. Null ends and self-loops are ignored; an empty table gives an empty
    result.
    """
    a, b = (F.col(f"`{c}`").cast("bigint") for c in edges.columns[:2])
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        a.isNotNull() & b.isNotNull() & (a != b)
    )
    edges = stored(pairs.mapInArrow(_local_forest, "a bigint, b bigint").where("a > b"))
    known = None
    for _ in range(MAX_ROUNDS):
        last, edges = edges, stored(_small_star(_large_star(edges)))
        discard(last)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == known or not now[0]:
            return edges.toDF("node", "component")
        known = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
