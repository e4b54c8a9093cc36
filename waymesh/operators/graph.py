"""Topology of segment networks as node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocking, matching


def endpoint_clusters(rows: DataFrame, metres: float) -> DataFrame:
    """id, which, cluster: endpoints joined by chains of gaps within a distance."""
    e = blocking.endpoints(rows).withColumn("node", F.concat_ws("#", "id", "which"))
    near = blocking.point_join(e, e, metres).filter("node < r_node").select(F.col("node").alias("u"), F.col("r_node").alias("v"))
    own = matching.components(near)
    return e.join(own, "node", "left").select("id", "which", "p", F.coalesce("component", "node").alias("cluster"))


def topology(clusters: DataFrame) -> DataFrame:
    """id, from_degree, to_degree, dead_end, intersection, signature; degree: segments that meet in a cluster."""
    degree = clusters.groupBy("cluster").agg(F.count_distinct("id").alias("degree"))
    ends = clusters.join(degree, "cluster").groupBy("id").agg(F.max(F.when(F.col("which") == 0, F.col("degree"))).alias("from_degree"), F.max(F.when(F.col("which") == 1, F.col("degree"))).alias("to_degree"))
    return ends.withColumns(
        {
            "dead_end": (F.least("from_degree", "to_degree") == 1), "intersection": (F.greatest("from_degree", "to_degree") >= 3),
            "signature": F.array_sort(F.array("from_degree", "to_degree")),
        }
    )


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct u < v without loops."""
    return edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def degrees(edges: DataFrame) -> DataFrame:
    return both_ways(edges).groupBy(F.col("u").alias("node")).agg(F.count("*").alias("degree"))


def triangles(edges: DataFrame) -> DataFrame:
    """node, triangles. Edges point to the end of higher degree, so that a hub never pairs its neighbours."""
    d = degrees(edges)
    ranked = edges.join(d.select(F.col("node").alias("u"), F.col("degree").alias("du")), "u").join(d.select(F.col("node").alias("v"), F.col("degree").alias("dv")), "v")
    up = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    out = ranked.select(F.when(up, F.col("u")).otherwise(F.col("v")).alias("a"), F.when(up, F.col("v")).otherwise(F.col("u")).alias("b"))
    wedge = out.join(out.select("a", F.col("b").alias("c")), "a").filter("b < c")
    closed = wedge.join(undirected(out.select(F.col("a").alias("u"), F.col("b").alias("v"))).toDF("b", "c"), ["b", "c"])
    return closed.select(F.explode(F.array("a", "b", "c")).alias("node")).groupBy("node").agg(F.count("*").alias("triangles"))


def clustering(edges: DataFrame) -> DataFrame:
    """node, degree, triangles, coefficient."""
    t = degrees(edges).join(triangles(edges), "node", "left").fillna(0, ["triangles"])
    pairs = F.col("degree") * (F.col("degree") - 1) / 2
    return t.withColumn("coefficient", F.when(pairs > 0, F.col("triangles") / F.when(pairs > 0, pairs)).otherwise(0.0))


def two_hop(edges: DataFrame) -> DataFrame:
    """node, two_hop: distinct nodes at distance two."""
    b = both_ways(edges)
    reach = b.join(b.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").filter("u <> w").select("u", "w").distinct()
    return reach.join(b.select("u", F.col("v").alias("w")), ["u", "w"], "left_anti").groupBy(F.col("u").alias("node")).agg(F.count("*").alias("two_hop"))


def squares(edges: DataFrame) -> DataFrame:
    """node, squares: 4-cycles through each node, from pairs of nodes with common neighbours."""
    b = both_ways(edges)
    common = b.join(b.select(F.col("u").alias("w"), "v"), "v").filter("u <> w").groupBy("u", "w").agg(F.count("*").alias("n"))
    return common.groupBy(F.col("u").alias("node")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("squares"))


def within_hops(edges: DataFrame, starts: DataFrame, hops: int) -> DataFrame:
    """start, node, hop: least number of hops up to a bound, from a table of start nodes (node)."""
    b = both_ways(edges)
    seen = starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("hop"))
    front = seen
    for h in range(1, hops + 1):
        front = front.join(b, front["node"] == b["u"]).select("start", F.col("v").alias("node")).distinct().join(seen.select("start", "node"), ["start", "node"], "left_anti").withColumn("hop", F.lit(h))
        seen = seen.unionByName(front)
    return seen


def _cuts(pairs: list[tuple[str, str]]) -> tuple[set[str], set[tuple[str, str]]]:
    """(articulation points, bridges) by one iterative depth-first walk."""
    near: dict[str, list[str]] = {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    seen: dict[str, int] = {}
    low: dict[str, int] = {}
    points, bridges = set(), set()
    for root in sorted(near):
        if root in seen:
            continue
        seen[root] = low[root] = len(seen)
        children = 0
        stack = [(root, "", iter(sorted(near[root])))]
        while stack:
            at, parent, rest = stack[-1]
            step = next(rest, None)
            if step is None:
                stack.pop()
                if stack:
                    up = stack[-1][0]
                    low[up] = min(low[up], low[at])
                    if low[at] > seen[up]:
                        bridges.add((min(up, at), max(up, at)))
                    if up != root and low[at] >= seen[up]:
                        points.add(up)
            elif step not in seen:
                seen[step] = low[step] = len(seen)
                children += at == root
                stack.append((step, at, iter(sorted(near[step]))))
            elif step != parent:
                low[at] = min(low[at], seen[step])
        if children > 1:
            points.add(root)
    return points, bridges


def cut_points_and_bridges(edges: DataFrame) -> DataFrame:
    """kind (articulation or bridge), u, v, of each connected component: a component is one task's work."""
    import pandas as pd

    named = edges.join(matching.components(edges).withColumnRenamed("node", "u"), "u")

    def work(part: pd.DataFrame) -> pd.DataFrame:
        points, bridges = _cuts(list(zip(part["u"], part["v"], strict=True)))
        rows = [("articulation", p, None) for p in sorted(points)] + [("bridge", *b) for b in sorted(bridges)]
        return pd.DataFrame(rows, columns=["kind", "u", "v"])

    return named.groupBy("component").applyInPandas(work, "kind string, u string, v string")


def _blocks(pairs: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """The biconnected blocks of an edge list, each sorted, in order of their first edge."""
    near: dict[str, list[str]] = {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    seen: dict[str, int] = {}
    low: dict[str, int] = {}
    open_edges: list[tuple[str, str]] = []
    out = []
    for root in sorted(near):
        if root in seen:
            continue
        seen[root] = low[root] = len(seen)
        stack = [(root, "", iter(sorted(near[root])))]
        while stack:
            at, parent, rest = stack[-1]
            step = next(rest, None)
            if step is None:
                stack.pop()
                if stack:
                    up = stack[-1][0]
                    low[up] = min(low[up], low[at])
                    if low[at] >= seen[up]:  # what was opened since the walk went down from `up` is one block
                        block = []
                        while not block or block[-1] != (up, at):
                            block.append(open_edges.pop())
                        out.append(sorted((min(e), max(e)) for e in block))
            elif step not in seen:
                seen[step] = low[step] = len(seen)
                open_edges.append((at, step))
                stack.append((step, at, iter(sorted(near[step]))))
            elif step != parent and seen[step] < seen[at]:
                open_edges.append((at, step))
                low[at] = min(low[at], seen[step])
    return sorted(out)


def biconnected(edges: DataFrame, most: int = 12) -> DataFrame:
    """u, v, block, cluster: every edge's biconnected block, and blocks joined in canonical order into clusters of at most `most` edges.

    A block of more edges is a cluster of its own. A component is one task's work.
    """
    import pandas as pd

    named = edges.join(matching.components(edges).withColumnRenamed("node", "u"), "u")

    def work(part: pd.DataFrame) -> pd.DataFrame:
        rows, cluster, held = [], 0, 0
        for i, block in enumerate(_blocks(list(zip(part["u"], part["v"], strict=True)))):
            if held and held + len(block) > most:
                cluster, held = cluster + 1, 0
            held += len(block)
            rows += [(u, v, f"{part['component'].iloc[0]}/{i}", f"{part['component'].iloc[0]}/c{cluster}") for u, v in block]
        return pd.DataFrame(rows, columns=["u", "v", "block", "cluster"])

    return named.groupBy("component").applyInPandas(work, "u string, v string, block string, cluster string")


def degree_signatures(edges: DataFrame) -> DataFrame:
    """node, degree, around: every node's degree and the sorted degrees of its neighbours."""
    d = degrees(edges)
    b = both_ways(edges).join(d.select(F.col("node").alias("v"), F.col("degree").alias("near")), "v")
    return b.groupBy(F.col("u").alias("node")).agg(F.count("*").alias("degree"), F.array_sort(F.collect_list("near")).alias("around"))


def degree_similarity(a, b):
    """1, 0.67, 0.33 or 0 for degrees that differ by 0, 1, 2 or more."""
    step = F.abs(a - b)
    return F.when(step == 0, 1.0).when(step == 1, 0.67).when(step == 2, 0.33).otherwise(0.0)
