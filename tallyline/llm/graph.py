"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


#: Edges up to which one task joins them, within a MB of memory; beyond, rounds of exchanges do.
FEW = 1 << 14


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all edges of a task, the smallest node on top."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = x = above[above[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays([pa.array([*above], pa.int64()), pa.array([top(x) for x in above], pa.int64())], names=["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    ``FEW`` edges, as counted, are joined by one task; with more: rounds of large-star and small-star, each a grouping for the smallest neighbour and a
    join back to it; no neighbour list is gathered, and the lineage is cut each round. The
    edges end as stars around the smallest nodes; rounds grow with the logarithm of the nodes.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    if now.count() <= FEW:
        return now.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).coalesce(1).mapInArrow(_joined, "node long, component long")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        star = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        near = star.join(least, "a")
        small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        last, now = now, materialize(small.where("a <> b").distinct(), "edges")
        discard(last)
        row = now.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
        if (row.n, row.h) == state:
            break
        state = (row.n, row.h)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
