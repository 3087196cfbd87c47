"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum, pre-aggregated before it is shuffled, and an equi-join, in which the edges of hubs are not
shuffled at all; nothing is gathered in the driver but four numbers a task. Rounds grow with the logarithm of the longest chain.
Before the first, each task joins what CHUNK of its own edges join; where that were all there are, no round is needed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.llm.common import staged, tally


#: Nodes of fewer edges are no hubs: a task joins so many rows in no time.
LEAST_HUB = 10_000
#: Edges that a task joins at once.
CHUNK = 250_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges, and of each the smallest that it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        rx, ry = root[x], root[y]
        low = np.minimum(rx, ry)
        np.minimum.at(root, rx, low)
        np.minimum.at(root, ry, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def _joined(chunk: int):
    """Edges (a, b) to stars (a, b, at) of as many as chunk of them; at tells these apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = TaskContext.get().partitionId() << 32, []

        def out() -> pa.RecordBatch:
            a, b = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            more = a != b
            return pa.RecordBatch.from_arrays([pa.array(a[more]), pa.array(b[more]), pa.array(np.full(int(more.sum()), at))], ["a", "b", "at"])

        for batch in batches:
            for some in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                if sum(len(x) for x, _ in held) + some.num_rows > chunk:
                    yield out()
                    at, held = at + 1, []
                held.append((some.column(0).to_numpy(), some.column(1).to_numpy()))
        if held:
            yield out()

    return run


def _mark(edges: DataFrame) -> tuple[int, int]:
    return tally(edges, F.xxhash64("a", "b"))[:2]


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _has_hubs(edges: DataFrame, total: int) -> bool:
    return total > LEAST_HUB and bool(_both(edges).groupBy("a").count().where(F.col("count") > max(LEAST_HUB, total // 1000)).limit(1).count())


def _with_least(edges: DataFrame, least: DataFrame, total: int, hubs: bool) -> DataFrame:
    """edges (a, b) with m of their a. The edges of hubs meet their row where they are; at most some 2,000 nodes can hold over a thousandth of all ends."""
    if not hubs:
        return edges.join(least.select("a", "m"), "a")
    few = F.broadcast(least.where(F.col("n") > max(LEAST_HUB, total // 1000)).select("a", "m"))
    others = edges.join(few, "a", "left_anti").join(least.select("a", "m"), "a")
    return edges.join(few, "a").unionAll(others)


def _large_star(edges: DataFrame, total: int, hubs: bool) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("n"))
    return _with_least(both, least, total, hubs).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, total: int, hubs: bool) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    moved = _with_least(edges, least, total, hubs).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scope: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b), both long: root is the smallest node that a node reaches.

    Loops, repeated edges and null ends are ignored; no edges give an empty table."""
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    edges = staged(edges.mapInArrow(_joined(CHUNK), "a long, b long, at long"), scope)
    _, _, first, last = tally(edges, F.col("at"))
    edges = edges.select("a", "b")
    mark = _mark(edges) if first != last else None  # of one task and chunk: joined, or none
    for _ in range(most_rounds):
        if mark is None:
            break
        hubs = _has_hubs(edges, mark[0])
        edges = staged(_small_star(_large_star(edges, mark[0], hubs), mark[0], hubs), scope)
        now = _mark(edges)
        mark = None if now == mark else now
    if mark is not None:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
