"""Connected components of an edge table, by alternating stars in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


BLOCK = 500_000


def contracted(edges: DataFrame, parts: int) -> DataFrame:
    """Edges (u, v) of a written table, dealt over `parts` tasks, each contracted to stars around its components' least nodes.

    A task's result has fewer rows than nodes, whatever the number of its edges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def find(i: int) -> int:
            root = i
            while (above := up.get(root, root)) != root:
                root = above
            while i != root:
                up[i], i = root, up.get(i, i)
            return root

        def join(us: list[int], vs: list[int]) -> None:
            for u, v in zip(us, vs, strict=True):
                a, b = find(u), find(v)
                if a != b:
                    up[max(a, b)] = min(a, b)
                    up.setdefault(min(a, b), min(a, b))

        for batch in batches:
            join(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if len(up) > 4 * BLOCK:  # keeps a task's table in bounds if its part is longer than planned
                yield out(up, find)
                up.clear()
        yield out(up, find)

    def out(up: dict, find) -> pa.RecordBatch:
        rows = [(i, r) for i in list(up) if (r := find(i)) != i]
        cols = list(zip(*rows, strict=True)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["u", "v"])

    return edges.select("u", "v").coalesce(parts).mapInArrow(run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its least neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node, component (the least node reachable) of every node of edges (u, v).

    Tasks of about BLOCK edges each contract their own edges first and after each round, so that
    few rows are shuffled and few rounds are needed; edges of one such task need no round at all.
    Each round writes its edges to the shared folder, which cuts lineage; the joins on hub nodes are
    of one side against one row a node, so that Spark can split a hub's partition. The rounds end
    when the edges are stars: each left node has one right node, and no right node stands on the
    left. That takes a logarithm of the longest path.
    """
    now = edges.filter(F.col("u") != F.col("v"))
    for _ in range(most_rounds):
        raw = written(now.select("u", "v"))
        parts = max(1, -(-raw.count() // BLOCK))
        now = written(contracted(raw, parts))
        dropped(raw)
        ends = now.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("to")), F.struct(F.col("v").alias("node"), F.lit(None).cast("long").alias("to")))))
        seen = ends.groupBy("node").agg(F.min("to").alias("a"), F.max("to").alias("b"), F.max(F.col("to").isNull()).alias("right"))
        if parts == 1 or seen.filter("a <> b OR (right AND a IS NOT NULL)").isEmpty():
            return seen.select("node", F.coalesce("a", "node").alias("component"))
        now = _small_star(_large_star(now)).filter(F.col("u") != F.col("v"))
    raise RuntimeError("components did not settle")
