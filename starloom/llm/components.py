"""Connected components of an edge table.

First every task replaces the edges it reads by a spanning forest of them
(union-find over at most ``FOREST_NODES`` nodes at a time): edges from each
node to the smallest node it reaches there.  This is done twice, the second
time over parts of about ``FOREST_EDGES`` edges dealt evenly, so a hot node
is one edge per part.  What the parts leave apart is joined by alternating
star contraction, entirely as joins and aggregates: the large star hooks
every larger neighbour of a node to the smallest node of its neighbourhood,
the small star hooks the smaller ones, until all edges are stars; a
logarithmic number of rounds suffices.  Every step cuts the lineage with
``checkpoint()`` (the shared folder of ``spark.checkpoint.dir``), so a lost
executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir

FOREST_NODES = 1 << 18
FOREST_EDGES = 1 << 18


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, smallest node it reaches) for all nodes of the edges (a, b)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        up = parent.setdefault(x, x)
        while up != x:
            parent[x] = parent[up]
            x, up = up, parent[up]
        return x

    def done() -> pa.RecordBatch:
        nodes = list(parent)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["a", "b"])

    for batch in batches:
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > FOREST_NODES:
            yield done()
            parent.clear()
    yield done()


def _forests(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(forest, "a long, b long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hooked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.union(least.select("a", F.col("m").alias("b")))


def _all_stars(edges: DataFrame) -> bool:
    """Has every node one centre, and is every centre its own?"""
    ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), "b"))
    return ends.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where("lo <> hi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns a, b; no
    nulls; repeated edges are harmless); the component is its smallest node.
    Self edges are ignored beyond naming their node."""
    ensure_checkpoint_dir(edges.sparkSession)
    first = _forests(edges).checkpoint()
    parts = -(-first.count() // FOREST_EDGES)
    now = _forests(first.repartition(max(1, parts))).where("a <> b").checkpoint()
    while not _all_stars(now):
        now = _small_star(_large_star(now)).distinct().checkpoint()
    return first.select(F.col("a").alias("node"), F.col("a").alias("component")) \
        .union(now.select("a", "b")).groupBy("node").agg(F.min("component").alias("component"))
