"""Connected components of an edge table by alternating large and small stars; labels are each component's least node."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayesmill.llm.common import forget, join_counted, saved

FOREST_NODES = 200_000  # of a task that contracts edges
TASK_EDGES = FOREST_NODES // 2


class Forest:
    """Union-find over nodes met so far; the least node of a tree is its root."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def top(self, x: int) -> int:
        root = self.root
        while (r := root.setdefault(x, x)) != x:
            root[x] = root[r]
            x = r
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.root[max(x, y)] = min(x, y)

    def stars(self) -> tuple[list[int], list[int]]:
        """Every node but the roots, and its root; the forest is empty afterwards."""
        pairs = [(x, self.top(x)) for x in list(self.root)]
        pairs = [(x, r) for x, r in pairs if x != r]
        self.root = {}
        return [x for x, _ in pairs], [r for _, r in pairs]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task as stars on their least nodes, told whenever FOREST_NODES nodes are held."""
    forest = Forest()
    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            forest.join(x, y)
        if len(forest.root) >= FOREST_NODES:
            yield _stars(forest)
    yield _stars(forest)


def _stars(forest: Forest) -> pa.RecordBatch:
    low, high = forest.stars()
    return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["u", "v"])


def _stars_only(at: DataFrame) -> bool:
    """Whether each node hangs on one other node, which hangs on none."""
    ends = at.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        at.select(F.col("v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    odd = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where((F.col("low") > 1) | ((F.col("low") > 0) & (F.col("high") > 0)))
    return odd.limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; self loops alone give no row.

    Tasks contract their own edges first, up to TASK_EDGES each; where one task holds all, that is the result. Else each
    round hangs every node's larger neighbours, and its smaller ones, on its least neighbour, until only stars are left;
    the rounds grow with the logarithm of the longest path.
    Nothing but the answer to "only stars?" comes to the driver.
    """
    up = edges.where(F.col("a") != F.col("b")).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    tasks = max(1, -(-up.count() // TASK_EDGES))
    at = saved(up.coalesce(tasks).mapInArrow(_contract, "u long, v long").distinct(), "edges")
    while tasks > 1 and not _stars_only(at):
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "least")
        # a large component's least node has most of its edges: it is joined apart
        large = saved(join_counted(both.where(F.col("v") > F.col("u")), least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, at = at, saved(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        forget(before, least, large)
    tops = at.select(F.col("v").alias("node")).distinct()
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops.withColumn("component", F.col("node")))
