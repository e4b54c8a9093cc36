"""Alignment, blocks of graphs, geodesics and verdict rules on small fixtures."""

import math

import pytest
from pyspark.sql import functions as F

from waymesh.functions import geometry as g
from waymesh.functions import text as tx
from waymesh.operators import graph, verdicts
from waymesh.operators.alignment import align
from waymesh.sources import files


def line(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_parallel_lines_align_whole_and_reversed():
    ref = line((0, 0), (100, 0))
    got = align(ref, line((0, 5), (100, 5)))
    assert got[:4] == pytest.approx((0, 1, 0, 1), abs=0.02) and not got[4]
    got = align(ref, line((100, 5), (0, 5)))
    assert got[:4] == pytest.approx((0, 1, 0, 1), abs=0.02) and got[4]


def test_a_part_aligns_with_its_span():
    got = align(line((0, 0), (200, 0)), line((50, 3), (150, 3)))
    assert got[:4] == pytest.approx((0.25, 0.75, 0, 1), abs=0.02)


def test_parting_ends_are_cut_off():
    got = align(line((0, 0), (200, 0)), line((0, 2), (120, 2), (140, 150)))
    assert got[7] and got[1] < 0.75


def test_lines_without_length_align_with_nothing():
    assert align(line((1, 1), (1, 1)), line((0, 0), (1, 0))) == (None,) * 8 and align(None, line((0, 0), (1, 0)))[0] is None


def brute_blocks(pairs):
    """Edges are of one block if a simple cycle holds both: union over all simple cycles."""
    import itertools

    up = {e: e for e in pairs}

    def find(e):
        while up[e] != e:
            e = up[e]
        return e

    nodes = sorted({n for e in pairs for n in e})
    have = set(pairs)
    for size in range(3, len(nodes) + 1):
        for c in itertools.permutations(nodes, size):
            if c[0] == min(c) and c[1] < c[-1]:
                walk = [tuple(sorted(e)) for e in zip(c, c[1:] + c[:1], strict=True)]
                if all(e in have for e in walk):
                    for e in walk[1:]:
                        up[find(e)] = find(walk[0])
    out = {}
    for e in pairs:
        out.setdefault(find(e), set()).add(e)
    return sorted(map(sorted, out.values()))


def test_biconnected_blocks_equal_brute_force(spark):
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("d", "f"), ("f", "g")]
    frame = spark.createDataFrame(pairs, "u string, v string")
    blocks, clusters = {}, {}
    for r in graph.biconnected(frame, most=4).collect():
        blocks.setdefault(r.block, []).append((r.u, r.v))
        clusters.setdefault(r.cluster, []).append((r.u, r.v))
    assert sorted(map(sorted, blocks.values())) == brute_blocks(pairs)
    assert all(len(x) <= 4 for x in clusters.values()) and sum(map(len, clusters.values())) == len(pairs)


def test_geodesic_is_near_known_lengths(spark):
    # one degree of a meridian at the equator, and one of the equator
    rows = spark.range(1).select(*[g.geodesic(g.point(0.0, 0.0), g.point(x, y)).alias(n) for n, x, y in (("north", 0.0, 1.0), ("east", 1.0, 0.0), ("none", 0.0, 0.0))]).first()
    assert rows.north == pytest.approx(110574.4, abs=5) and rows.east == pytest.approx(111319.5, abs=5) and rows.none == 0
    assert not math.isnan(rows.none)


def test_names_and_routes(spark):
    rows = [("I-90", "Interstate 90"), ("Main Street", "Main St"), ("US Highway 101", "Route 66"), (None, "x"), ("42nd Street", "Elm")]
    x = spark.createDataFrame(rows, "a string, b string").select("a", tx.numeric_match(F.col("a"), F.col("b")).alias("m"), tx.names_compatible(F.col("a"), F.col("b")).alias("c"), tx.likely_same(F.col("a"), F.col("b")).alias("s"))
    got = {r.a: (r.m, r.c, r.s) for r in x.collect()}
    assert got == {"I-90": (1.0, True, True), "Main Street": (None, False, True), "US Highway 101": (0.0, False, False), None: (None, None, False), "42nd Street": (None, False, False)}


def test_undo_takes_one_decision_off(spark):
    rows = [(1, 1, "keep", False), (1, 2, "drop", False), (1, 3, "", True), (2, 1, "keep", False), (2, 2, "", True), (2, 3, "", True), (3, 1, "", True), (3, 2, "drop", False)]
    frame = spark.createDataFrame(rows, "who int, at int, what string, undo boolean")
    got = {r.who: (r.decision, r.n) for r in verdicts.standing_decisions(frame, "who", F.col("what"), F.col("undo"), "at").collect()}
    assert got == {1: ("keep", 1), 3: ("drop", 1)}


def test_columns_resolve_without_regard_to_case(spark):
    frame = spark.createDataFrame([(1, 2)], "Name int, other int")
    assert [files.resolve_column(frame, n) for n in ("name", "Name", "missing", None)] == ["Name", "Name", None, None]
