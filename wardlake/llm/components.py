"""Connected components of a graph given as a table of edges."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import Scratch

#: Edges one task contracts at once; bounds its memory.
EDGES_TOGETHER = 1 << 17


def _contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """The edges of each task replaced by one from every node to the smallest node they reach there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (above := parent.get(root, root)) != root:
                root = above
            while x != root:
                parent[x], x = root, parent.get(x, x)
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = find(a), find(b)
                parent[max(a, b)] = parent.setdefault(min(a, b), min(a, b))
        nodes = np.array(list(parent), np.int64)
        roots = np.array([find(x) for x in nodes.tolist()], np.int64)
        inner = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[inner]), pa.array(roots[inner])], ["a", "b"])

    return edges.repartition(tasks).mapInArrow(run, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of an edge (columns ``a, b``, long).

    First every task contracts its share of the edges. Then two steps alternate in which every node
    hands its smallest neighbour to its larger, then to its smaller neighbours, until all edges
    point at roots; a single share is done at once. Each round is written, so it never runs twice;
    nothing but counts and a checksum reaches the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    edges = scratch.keep(edges, f"{label}-edges")
    tasks = max(1, math.ceil(edges.count() / EDGES_TOGETHER))
    now, seen, turn = scratch.keep(_contracted(edges, tasks), f"{label}-0"), None, 0
    scratch.drop(f"{label}-edges")
    while tasks > 1:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            break
        seen = state
        both = now.union(now.select(F.col("b"), F.col("a")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.keep(large.filter("a > b").distinct(), f"{label}-{turn}-large")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(smallest, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(smallest.select("a", F.col("m").alias("b")))
        after = scratch.keep(small.filter("a > b").distinct(), f"{label}-{turn + 1}")
        scratch.drop(f"{label}-{turn}", f"{label}-{turn}-large")
        now, turn = after, turn + 1
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
