"""Functions and operators on small fixtures with known answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from waymesh.functions import geometry as g
from waymesh.functions import ranges
from waymesh.functions import text as tx
from waymesh.operators import blocking, bridges, graph, integration, labels, matching

SCHEMA = "id string, xy array<struct<x:double,y:double>>"


def lines(spark, rows):
    return spark.createDataFrame([(i, [tuple(map(float, p)) for p in xy]) for i, xy in rows], SCHEMA)


def value(spark, expr, rows):
    return [r[0] for r in lines(spark, rows).orderBy("id").select(expr).collect()]


L = [("a", [(0, 0), (100, 0)]), ("b", [(0, 0), (3, 4), (3, 10)]), ("c", [(5, 5), (5, 5)])]


def test_measures(spark):
    xy = F.col("xy")
    assert value(spark, g.length(xy), L) == [100.0, 11.0, 0.0]
    assert value(spark, g.heading(xy), L[:1]) == [0.0]
    assert value(spark, g.sinuosity(xy), L)[1] == pytest.approx(11 / math.hypot(3, 10))
    assert value(spark, g.interpolate(xy, F.lit(5.0)), L)[1] == (3.0, 4.0)
    assert value(spark, g.length(g.sub_line(xy, F.lit(0.75), F.lit(0.25))), L)[:2] == pytest.approx([50.0, 5.5])
    assert value(spark, g.sub_line(xy, F.lit(0.5), F.lit(0.5)), L) == [None] * 3
    assert value(spark, g.project(g.point(50, 7), xy), L)[0] == (7.0, 0.5)
    assert value(spark, F.size(g.turns(xy)), L) == [0, 1, 0]


def test_length_within_equals_sampling(spark):
    rng = random.Random(1)
    rows = [(f"l{i}", [(rng.uniform(0, 60), rng.uniform(0, 60)) for _ in range(3)]) for i in range(12)]
    df = lines(spark, rows)
    pairs = df.select(F.col("id").alias("i"), F.col("xy").alias("a")).crossJoin(df.select(F.col("id").alias("j"), F.col("xy").alias("b")))
    got = {(r.i, r.j): r.w for r in pairs.select("i", "j", g.within(F.col("a"), F.col("b"), 10.0).alias("w")).collect()}

    def dist(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    for i, a in rows:
        for j, b in rows:
            want = 0.0
            for s, e in zip(a, a[1:], strict=False):
                n = 2000
                hits = sum(min(dist((s[0] + (k + 0.5) / n * (e[0] - s[0]), s[1] + (k + 0.5) / n * (e[1] - s[1])), c, d) for c, d in zip(b, b[1:], strict=False)) <= 10 for k in range(n))
                want += hits / n * math.dist(s, e)
            assert got[i, j] == pytest.approx(want, abs=0.2)


def test_box_join_reports_each_pair_once(spark):
    rng = random.Random(2)
    rows = [(f"l{i}", [(rng.uniform(-300, 300), rng.uniform(-300, 300)) for _ in range(2)]) for i in range(60)]
    got = sorted((r.ref_id, r.target_id) for r in blocking.box_join(lines(spark, rows), lines(spark, rows), 20.0).collect())
    box = lambda xy: (min(p[0] for p in xy), min(p[1] for p in xy), max(p[0] for p in xy), max(p[1] for p in xy))
    want = []
    for i, a in rows:
        for j, b in rows:
            p, q = box(a), box(b)
            if p[0] <= q[2] + 20 and p[2] >= q[0] - 20 and p[1] <= q[3] + 20 and p[3] >= q[1] - 20:
                want.append((i, j))
    assert got == sorted(want)


def test_greedy_equals_sequential(spark):
    rng = random.Random(3)
    rows = [(f"r{i}", f"t{j}", round(rng.random(), 2), rng.random() < 0.5, 0.5) for i in range(15) for j in range(15) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "ref_id string, target_id string, confidence double, same_name boolean, coverage double")
    got = sorted((r.ref_id, r.target_id) for r in matching.greedy(df).collect())
    used, want = set(), []
    for r, t, c, _, _ in sorted(rows, key=lambda x: (-x[2], -x[3], x[0], x[1])):
        if c >= 0.1 and r not in used and t not in used:
            used |= {r, t}
            want.append((r, t))
    assert got == sorted(want)


def test_slivers_never_glue(spark):
    cols = "ref_id string, target_id string, confidence double, ref_from double, ref_to double, target_from double, target_to double, ref_length double, target_length double"
    rows = [("r1", "t1", 0.9, 0.0, 1.0, 0.0, 1.0, 50.0, 50.0), ("r2", "t2", 0.9, 0.0, 1.0, 0.0, 1.0, 50.0, 50.0), ("r1", "t2", 0.9, 0.0, 0.05, 0.0, 0.05, 50.0, 50.0), ("r3", "t3", 0.3, 0.0, 1.0, 0.0, 1.0, 50.0, 50.0)]
    got = matching.match_components(spark.createDataFrame(rows, cols)).collect()
    assert sorted((r.ref_id, r.target_id) for r in got) == [("r1", "t1"), ("r2", "t2")] and len({r.component for r in got}) == 2


def test_ranges(spark):
    df = spark.createDataFrame([("a", 0.1, 0.3), ("a", 0.305, 0.5), ("a", 0.8, 0.9), ("b", 0.0, 1.0)], "id string, start double, end double")
    merged = ranges.merge(df, "id")
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 0.1, 0.5), ("a", 0.8, 0.9), ("b", 0.0, 1.0)]
    assert sorted((r.id, round(r.start, 3), round(r.end, 3)) for r in ranges.complement(merged, "id").collect()) == [("a", 0.0, 0.1), ("a", 0.5, 0.8), ("a", 0.9, 1.0)]


def test_names(spark):
    df = spark.createDataFrame([("St Mary's  Street",), (" N. Main-Road ",), (None,)], "n string")
    assert [r[0] for r in df.select(tx.normalise(F.col("n"))).collect()] == ["saint mary's st", "n main rd", None]
    assert tx.indel("abcd", "abxd") == 0.75 and tx.lcs("abcbdab", "bdcaba") == 4
    assert tx.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert tx.token_set("main st", "main st north") == 1.0 and tx.token_sort("b a", "a b") == 1.0 and tx.partial("main", "the main st") == 1.0


def test_consensus_tiers(spark):
    rows = [(1, s, "A", 0.5) for s in range(3)] + [(2, 0, "A", 0.5), (2, 1, "A", 0.7), (2, 2, "B", 0.1)] + [(3, s, "A", 1.0) for s in range(3)] + [(3, 3, "ABSTAIN", 1.0), (4, 0, "A", 1.0)]
    got = {r.group_id: (r.tier, r.mean_confidence) for r in labels.consensus(spark.createDataFrame(rows, "group_id int, seat int, choice string, conf double")).collect()}
    assert got == {1: ("unanimous", 0.5), 2: ("majority", 0.6), 3: ("quorum", 1.0), 4: ("none", 1.0)}


def test_cut_points_and_bridges(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("d", "e")], "u string, v string")
    got = sorted((r.kind, r.u, r.v) for r in graph.cut_points_and_bridges(e).collect())
    assert got == [("articulation", "c", None), ("articulation", "d", None), ("bridge", "c", "d"), ("bridge", "d", "e")]


def test_planarised_and_net_new(spark):
    cross = lines(spark, [("a", [(0, 0), (10, 10)]), ("b", [(0, 10), (10, 0)])]).withColumn("level", F.lit(0))
    assert sorted(r.id for r in integration.planarised(cross).collect()) == ["a.0", "a.1", "b.0", "b.1"]
    over = cross.withColumn("level", F.when(F.col("id") == "a", 1).otherwise(0))
    assert integration.planarised(over).count() == 2
    t, r = lines(spark, [("t", [(0, 0), (100, 0)])]), lines(spark, [("r", [(0, 3), (40, 3)])])
    got = integration.net_new(t, r, 5.0).first()
    assert got.covered_m == pytest.approx(44.0, abs=1e-6) and got.net_m == pytest.approx(56.0, abs=1e-6)


def test_churn(spark):
    s = "local_id string, gers_id string"
    old, new = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], s), spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "4")], s)
    assert {r.local_id: r.category for r in bridges.churn(old, new).collect()} == {"a": "same", "b": "changed", "c": "lost", "d": "gained"}
