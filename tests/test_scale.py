"""What keeps work, memory and the driver's share in proportion to the input."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymesh.functions import geometry as g
from waymesh.operators import alignment, assignment, blocking, integration, matching
from waymesh.sources import synthetic

XY = "array<struct<x:double,y:double>>"


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize(
    ("name", "kernel", "most"),
    [
        ("sub_line", lambda a, b: g.length(g.sub_line(a, F.lit(0.75), F.lit(0.25))), 3),
        ("offsets", lambda a, b: g.percentile(g.distances_to_line(g.samples(b, 5.0, 3), a), 0.95), 3),
        ("samples", lambda a, b: g.mean(F.transform(g.samples(a, 10.0, 3), lambda p: p["x"])), 4),
        ("centre", lambda a, b: blocking.centre(a)["x"], 3),
        ("merged", lambda a, b: g.merged_parts(F.array(a, b)), 2),
    ],
)
def test_line_kernels_take_lengths_and_measures_once(spark, name, kernel, most):
    rows = spark.createDataFrame([([(0.0, 0.0), (3.0, 4.0)], [(0.0, 1.0), (3.0, 4.0)])], f"a {XY}, b {XY}")
    assert plan(rows.select(kernel(F.col("a"), F.col("b")).alias("v"))).count("aggregate(") <= most


def test_distances_of_lines_pair_their_pieces_a_few_times_only(spark):
    rows = spark.createDataFrame([([(0.0, 0.0), (3.0, 4.0)], [(0.0, 1.0), (3.0, 4.0)])], f"a {XY}, b {XY}")
    a, b = F.col("a"), F.col("b")
    assert plan(rows.select(g.percentile(g.vertex_distances(a, b), 0.95).alias("v"))).count("zip_with(") <= 2
    assert plan(rows.select(g.line_distance(a, b).alias("v"))).count("zip_with(") <= 4


def test_segments_and_written_tables_are_never_sent_to_the_driver(spark, sf_dir):
    r, t = synthetic.reference(spark, sf_dir), synthetic.target(spark, sf_dir)
    e = blocking.endpoints(matching.scratch(r.select("id", "xy")))
    joins = [blocking.box_join(r, t, 10.0), blocking.endpoint_pairs(r, 10.0), blocking.point_join(e, e, 10.0), e.join(r.select("id", "name"), "id"), e.join(matching.scratch(r.select("id")), "id", "left_anti")]
    for df in joins:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_alignments_of_a_block_equal_those_of_single_pairs_and_are_fast():
    rng = random.Random(3)

    def line(n):
        return np.cumsum([(rng.uniform(0, 40), rng.uniform(-20, 20)) for _ in range(n)], 0)

    refs = [line(rng.choice((2, 2, 3, 9, 40))) for _ in range(3000)]
    targets = [(x[::-1] if rng.random() < 0.5 else x)[: rng.choice((1, 2, 60))] + rng.gauss(0, 4) for x in refs]
    began = time.time()
    rows, fields = alignment.align_all(refs, targets)
    assert time.time() - began < 12  # 26 s and more pair by pair
    got = {int(i): tuple(f[k].item() for f in fields) for k, i in enumerate(rows)}
    points = lambda a: [{"x": x, "y": y} for x, y in a]
    for i in range(0, 3000, 100):
        assert got.get(i, (None,) * 8) == alignment.align(points(refs[i]), points(targets[i]))


def test_buffers_counted_by_spans_equal_those_counted_point_by_point():
    rng = random.Random(4)

    def far(grid, xy):
        best = np.full(len(grid), np.inf)
        for p, q in zip(xy, xy[1:], strict=False):
            v = q - p
            t = np.clip((grid - p) @ v / max(v @ v, 1e-12), 0, 1)
            best = np.minimum(best, np.hypot(*(grid - p - t[:, None] * v).T))
        return best

    def line():
        return np.cumsum([(rng.choice((0, 0, rng.randint(-30, 30))), rng.choice((0, rng.randint(-30, 30)))) for _ in range(rng.choice((1, 2, 3, 6)))], 0) + 0.1 * rng.randint(0, 9)

    refs = [line() for _ in range(200)]
    targets = [x + rng.randint(-6, 6) if rng.random() < 0.7 else line() for x in refs]
    want = []
    for a, b in zip(refs, targets, strict=True):
        p = np.concatenate([a, b])
        lo, hi = p.min(0) - 5, p.max(0) + 5
        grid = np.stack(np.meshgrid(np.arange(lo[0], hi[0], 0.5), np.arange(lo[1], hi[1], 0.5)), -1).reshape(-1, 2)
        x, y = far(grid, a) <= 5, far(grid, b) <= 5
        want.append((x & y).sum() / max((x | y).sum(), 1))
    assert list(assignment.iou_all(refs, targets, 5.0)) == want
    # a grid of 4e8 points, which is never held as a whole
    long = [np.array([(0.0, 0.0), (10000.0, 10000.0)])]
    assert assignment.iou_all(long, [long[0] + [0.0, 1.0]], 5.0, 0.5)[0] == pytest.approx(0.87, abs=0.01)


def test_pairs_of_a_product_are_looked_up_not_formed(spark, sf_dir):
    from waymesh.plans import relational

    at = relational.universe_product(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in at.splitlines() if "Join" in x]
    assert joins and all("gers_id" in x or "local_id" in x for x in joins)  # none by group alone


def test_conflicts_of_sets_do_not_meet_in_a_stream_of_rows(spark):
    rows = [(f"r{i}", f"t{i}{k}", 0.9 - k / 10, 0.0, 1.0, 0.0, 1.0, 50.0, 50.0) for i in range(40) for k in range(3)]
    pairs = spark.createDataFrame(rows, "ref_id string, target_id string, confidence double, ref_from double, ref_to double, target_from double, target_to double, ref_length double, target_length double")
    out = assignment.coverage_conflicts(pairs)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()  # a call and a frame for each set
    assert {(r.target_id, r.decision) for r in out.collect()} == {(f"t{i}{k}", "review" if k else "match") for i in range(40) for k in range(3)}


def test_orphans_near_the_network_are_not_paired_with_all_of_it(spark, monkeypatch):
    line = lambda x, y: [(float(x), float(y)), (float(x) + 5, float(y))]
    network = spark.createDataFrame([(f"n{i}", line(10 * i, 0)) for i in range(60)], f"id string, xy {XY}")
    lost = spark.createDataFrame([("a", line(0, 7)), ("b", line(300, 49.9)), ("c", line(300, 50.1)), ("d", line(300, 499)), ("e", line(300, 501))], f"id string, xy {XY}")
    seen, nearest = [], blocking.nearest

    def watched(left, right, metres, cell):
        seen.append((metres, {r.id for r in left.select("id").collect()}))
        return nearest(left, right, metres, cell)

    monkeypatch.setattr(blocking, "nearest", watched)
    got = {r.id: r.nearest_m for r in integration.orphan_components(lost, network).collect()}
    assert got == {"a": 7.0, "b": 49.9, "c": 50.1, "d": 499.0, "e": None}
    assert seen[-1] == (500.0, {"c", "d", "e"})
