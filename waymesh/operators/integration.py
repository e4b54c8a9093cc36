"""Screening, network integration and repair of unmatched segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import ranges
from . import blocking, matching

SCREENS: dict[str, Callable[..., DataFrame]] = {}


def screen(name: str) -> Callable:
    """Register a screen test: a function of (targets, ...) that returns id and outcome."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        SCREENS[name] = f
        return f

    return add


def mode_of(cls: Column) -> Column:
    return F.when(cls == "footway", "pedestrian").when(cls == "cycleway", "bicycle").when(cls.isNotNull(), "vehicle")


@screen("polygon_buffer")
def polygon_buffer(targets: DataFrame, polygons: DataFrame, vehicle: float = 5.0, bicycle: float = 2.0, pedestrian: float = 1.0) -> DataFrame:
    """FAIL where a line comes nearer to a polygon (ring in xy) than its mode's buffer; SKIP for unknown modes."""
    buffer = F.when(F.col("mode") == "vehicle", vehicle).when(F.col("mode") == "bicycle", bicycle).otherwise(pedestrian)
    t = targets.withColumn("mode", mode_of(F.col("class"))).select("id", "mode", "xy")
    ring = polygons.select("id", F.concat("xy", F.array(F.element_at("xy", 1))).alias("xy"))
    pairs = blocking.box_join(ring, t, max(vehicle, bicycle, pedestrian), 100.0, "poly_", "")
    hit = pairs.filter((g.line_distance(F.col("poly_xy"), F.col("xy")) <= buffer) | inside(g.first(F.col("xy")), F.col("poly_xy"))).select("id").distinct().withColumn("hit", F.lit(True))
    return t.join(hit, "id", "left").select("id", F.when(F.col("mode").isNull(), "SKIP").when(F.col("hit"), "FAIL").otherwise("PASS").alias("outcome"))


def inside(p: Column, ring: Column) -> Column:
    """Whether a point is inside a closed ring, by crossings."""

    def crosses(s: Column) -> Column:
        a, b = s["a"], s["b"]
        return ((a["y"] > p["y"]) != (b["y"] > p["y"])) & (p["x"] < (b["x"] - a["x"]) * (p["y"] - a["y"]) / F.when(b["y"] != a["y"], b["y"] - a["y"]) + a["x"])

    return F.size(F.filter(g.pieces(ring), lambda s: F.coalesce(crosses(s), F.lit(False)))) % 2 == 1


@screen("length")
def length_screen(targets: DataFrame, least: float = 3.0) -> DataFrame:
    return targets.select("id", F.when(g.length(F.col("xy")) >= least, "PASS").otherwise("WARN").alias("outcome"))


@screen("fringe")
def fringe(targets: DataFrame, refs: DataFrame, cell: float = 50.0) -> DataFrame:
    """FAIL outside the raster of cells that references occupy, dilated by one cell."""
    occupied = refs.select(F.explode(g.cells(g.bbox(F.col("xy")), cell, cell)).alias("c")).distinct()
    mid = targets.select("id", g.midpoint(F.col("xy")).alias("m")).withColumn("c", F.struct(F.floor(F.col("m.x") / cell).cast("bigint").alias("cx"), F.floor(F.col("m.y") / cell).cast("bigint").alias("cy")))
    return mid.join(occupied.withColumn("hit", F.lit(True)), "c", "left").select("id", F.when(F.col("hit"), "PASS").otherwise("FAIL").alias("outcome"))


def report(tests: dict[str, DataFrame]) -> DataFrame:
    """test, outcome, n over all tests' results."""
    rows = None
    for name, t in tests.items():
        t = t.select(F.lit(name).alias("test"), "id", "outcome")
        rows = t if rows is None else rows.unionByName(t)
    return rows.groupBy("test", "outcome").agg(F.count("*").alias("n"))


def net_new(targets: DataFrame, refs: DataFrame, metres: float) -> DataFrame:
    """id, length_m, covered_m, net_m: what of each line lies outside the buffer of all nearby references.

    The covered measures of a line, over all references, are merged as intervals.
    """
    pairs = blocking.box_join(blocking.with_pieces(targets.select("id", "xy")), blocking.with_pieces(refs.select("id", "xy")), metres)
    covered = blocking.overlaps(pairs, ["ref_id"], metres).select(F.col("ref_id").alias("id"), "overlap_m")
    out = targets.select("id", g.length(F.col("xy")).alias("length_m")).join(covered, "id", "left").withColumn("covered_m", F.coalesce("overlap_m", F.lit(0.0)))
    return out.select("id", "length_m", "covered_m", (F.col("length_m") - F.col("covered_m")).alias("net_m"))


def remnants(targets: DataFrame, bridge: DataFrame, least: float = 3.0) -> DataFrame:
    """id `<id>_remnant_<i>`, parent, start, end, xy: unmatched parts of matched targets, `least` metres or more."""
    got = bridge.filter("decision = 'match'").select(F.col("local_id").alias("id"), F.col("start_frac").alias("start"), F.col("end_frac").alias("end"))
    gaps = ranges.complement(ranges.merge(got, "id"), "id")
    cut = gaps.join(targets.select("id", "xy"), "id").withColumn("xy", g.sub_line(F.col("xy"), F.col("start"), F.col("end"))).filter(g.length(F.col("xy")) >= least)
    i = F.row_number().over(Window.partitionBy("id").orderBy("start"))
    return cut.withColumn("i", i).select(F.concat("id", F.lit("_remnant_"), "i").alias("id"), F.col("id").alias("parent"), "start", "end", "xy")


def orphans(targets: DataFrame, refs: DataFrame, touch: float = 3.0, hop: float = 6.0, hops: int = 2) -> DataFrame:
    """id, hop: 0 where an end touches a reference, then hops over other targets; null is an orphan."""
    ends = blocking.endpoints(targets).select("id", "p")
    first = blocking.point_line_join(ends, refs.select("id", "xy"), touch).select("id").distinct().withColumn("hop", F.lit(0))
    links = blocking.point_join(ends, ends, hop).filter("id <> r_id").select("id", "r_id").distinct()
    seen = matching.scratch(first)
    for h in range(1, hops + 1):
        nxt = links.join(seen.filter(F.col("hop") == h - 1).select(F.col("id").alias("r_id")), "r_id").select("id").distinct().join(seen, "id", "left_anti").withColumn("hop", F.lit(h))
        seen = matching.scratch(seen.unionByName(nxt))
    return targets.select("id").join(seen, "id", "left")


def islands(rows: DataFrame, metres: float = 1.0) -> DataFrame:
    """component, n, total_m, is_main, severity of networks of touching segments."""
    near = blocking.endpoint_pairs(rows, metres).select(F.col("id").alias("u"), F.col("r_id").alias("v"))
    own = matching.components(near)
    named = rows.join(own.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    size = named.groupBy("component").agg(F.count("*").alias("n"), F.round(F.sum(g.length(F.col("xy"))), 3).alias("total_m"))
    top = size.agg(F.max(F.struct("n", "component")).alias("m")).select(F.col("m.component").alias("main"), F.lit(0).alias("i"))
    out = size.withColumn("i", F.lit(0)).join(F.broadcast(top), "i").withColumn("is_main", F.col("component") == F.col("main"))
    return out.select("component", "n", "total_m", "is_main", F.when(F.col("is_main"), "none").when(F.col("n") == 1, "critical").when(F.col("n") < 5, "high").otherwise("low").alias("severity"))


def drift(rows: DataFrame) -> DataFrame:
    """id, zigzag, spike, loop flags of noisy traces."""
    xy, n = F.col("xy"), F.size("xy")
    p = g.pieces(xy)

    def side(a: Column, b: Column) -> Column:
        return F.signum((a["b"]["x"] - a["a"]["x"]) * (b["b"]["y"] - b["a"]["y"]) - (a["b"]["y"] - a["a"]["y"]) * (b["b"]["x"] - b["a"]["x"]))

    m = F.greatest(F.size(p) - 1, F.lit(0))
    sides = F.zip_with(F.slice(p, 1, m), F.slice(p, 2, m), side)
    k = F.greatest(F.size(sides) - 1, F.lit(0))
    flips = F.size(F.filter(F.zip_with(F.slice(sides, 1, k), F.slice(sides, 2, k), lambda a, b: a * b < 0), lambda f: f))
    dense = n / F.greatest(g.length(xy), F.lit(1e-9)) >= 0.5
    sharp = F.exists(g.turns(xy), lambda t: t >= 90)
    pairs = F.flatten(F.transform(xy, lambda a, i: F.transform(F.filter(F.transform(xy, lambda b, j: F.struct(b.alias("p"), j.alias("j"))), lambda b: b["j"] >= i + 4), lambda b: g.distance(a, b["p"]))))
    return rows.select("id", (dense & (flips >= 3)).alias("zigzag"), sharp.alias("spike"), (F.exists(pairs, lambda d: d <= 10) & (g.length(xy) <= 50)).alias("loop"))


def snapped(rows: DataFrame, metres: float) -> DataFrame:
    """rows with both ends moved to the centroid of their endpoint cluster."""
    from .graph import endpoint_clusters

    c = endpoint_clusters(rows, metres)
    centre = c.groupBy("cluster").agg(F.avg("p.x").alias("x"), F.avg("p.y").alias("y"))
    at = c.join(centre, "cluster").groupBy("id").agg(*[F.max(F.when(F.col("which") == w, F.struct(F.col("x"), F.col("y")))).alias(name) for w, name in ((0, "a"), (1, "b"))])
    inner = F.slice("xy", 2, F.greatest(F.size("xy") - 2, F.lit(0)))
    return rows.join(at, "id").withColumn("xy", F.concat(F.array("a"), inner, F.array("b"))).drop("a", "b")


def crossings(rows: DataFrame, cell: float = 100.0) -> DataFrame:
    """a, b, x, y, fa, fb: inner crossings of pairs of segments of one level, with piecewise fractions."""
    one = rows.select("id", "level", F.posexplode(g.measured(F.col("xy"))).alias("i", "s"), g.length(F.col("xy")).alias("n")).select(F.concat_ws("#", "id", "i").alias("piece"), "id", "level", "s", "n", F.array("s.a", "s.b").alias("xy"))
    p = blocking.box_join(one, one, 0.0, cell, "a_", "b_").filter("a_id < b_id AND a_level = b_level")
    a, b, c, e = (F.col(x) for x in ("a_s.a", "a_s.b", "b_s.a", "b_s.b"))
    rx, ry, sx, sy = b["x"] - a["x"], b["y"] - a["y"], e["x"] - c["x"], e["y"] - c["y"]
    den = rx * sy - ry * sx
    t = ((c["x"] - a["x"]) * sy - (c["y"] - a["y"]) * sx) / F.when(den != 0, den)
    u = ((c["x"] - a["x"]) * ry - (c["y"] - a["y"]) * rx) / F.when(den != 0, den)
    hit = p.withColumns({"t": t, "u": u}).filter("t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1")
    frac = lambda side, v: (F.col(f"{side}_s.m") + F.col(v) * F.col(f"{side}_s.n")) / F.col(f"{side}_n")
    return hit.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), (a["x"] + F.col("t") * rx).alias("x"), (a["y"] + F.col("t") * ry).alias("y"), frac("a", "t").alias("fa"), frac("b", "u").alias("fb"))


def planarised(rows: DataFrame, cell: float = 100.0) -> DataFrame:
    """id `<id>.<i>`, parent, start, end, xy: segments cut at their crossings."""
    x = crossings(rows, cell)
    cuts = x.select(F.col("a").alias("id"), F.col("fa").alias("f")).unionAll(x.select("b", "fb")).groupBy("id").agg(F.array_sort(F.collect_set(F.round("f", 9))).alias("cuts"))
    all_cuts = F.array_distinct(F.concat(F.array(F.lit(0.0)), F.coalesce("cuts", F.array().cast("array<double>")), F.array(F.lit(1.0))))
    n = F.size("c")
    spans = F.zip_with(F.slice("c", 1, n - 1), F.slice("c", 2, n - 1), lambda s, e: F.struct(s.alias("start"), e.alias("end")))
    out = rows.join(cuts, "id", "left").withColumn("c", F.array_sort(all_cuts)).select("id", "xy", F.posexplode(spans).alias("i", "s"))
    return out.select(F.concat_ws(".", "id", "i").alias("id"), F.col("id").alias("parent"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), g.sub_line(F.col("xy"), F.col("s.start"), F.col("s.end")).alias("xy"))


def integrate(refs: DataFrame, targets: DataFrame, bridge: DataFrame, new_m: float = 20.0) -> DataFrame:
    """id, source, xy: references plus the unmatched targets with enough new geometry that connect to the network."""
    matched = bridge.filter("decision = 'match'").select(F.col("local_id").alias("id")).distinct()
    rest = targets.join(matched, "id", "left_anti").select("id", "xy")
    fresh = net_new(rest, refs, 5.0).filter(F.col("net_m") >= new_m).select("id")
    joined = orphans(rest.join(fresh, "id", "left_semi"), refs).filter("hop IS NOT NULL").select("id")
    return refs.select("id", F.lit("reference").alias("source"), "xy").unionByName(rest.join(joined, "id", "left_semi").select("id", F.lit("target").alias("source"), "xy"))


def promoted(candidates: DataFrame, refs: DataFrame, metres: float = 5.0, least: float = 10.0, joint: float = 3.0) -> DataFrame:
    """id of candidates whose halves overlap, by `least` metres each, references of different components of the network."""
    halves = F.array(*[F.struct(F.lit(i).alias("half"), g.sub_line(F.col("xy"), F.lit(i / 2), F.lit(i / 2 + 0.5)).alias("xy")) for i in (0, 1)])
    parts = candidates.select("id", F.inline(halves)).select("id", "half", "xy")
    pairs = blocking.box_join(blocking.with_pieces(parts), blocking.with_pieces(refs.select("id", "xy")), metres)
    over = blocking.overlaps(pairs, ["ref_id", "ref_half", "target_id"], metres).filter(F.col("overlap_m") >= least)
    own = network_components(refs, joint).withColumnRenamed("id", "target_id")
    at = over.join(own, "target_id").groupBy("ref_id").agg(F.collect_set(F.when(F.col("ref_half") == 0, F.col("component"))).alias("a"), F.collect_set(F.when(F.col("ref_half") == 1, F.col("component"))).alias("b"))
    differ = (F.size("a") > 0) & (F.size("b") > 0) & (F.size(F.array_union("a", "b")) > 1)
    return at.filter(differ).select(F.col("ref_id").alias("id"))


def network_components(rows: DataFrame, metres: float) -> DataFrame:
    """id, component: the least id of the segments that touching ends connect."""
    near = blocking.endpoint_pairs(rows, metres).select(F.col("id").alias("u"), F.col("r_id").alias("v"))
    own = matching.components(near).withColumnRenamed("node", "id")
    return rows.select("id").join(own, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def orphan_components(lost: DataFrame, network: DataFrame, joint: float = 6.0, within: float = 500.0) -> DataFrame:
    """id, component, n, nearest_m, priority of orphaned segments; nearest_m is null where the network is further than `within`.

    Priority goes by a segment's own length: high over 50 m, medium over 10 m, else low.
    """
    own = network_components(lost, joint)
    size = own.groupBy("component").agg(F.count("*").alias("n"))
    # a tenth of the way finds most; only the rest is paired with all within the whole of it
    close = matching.scratch(blocking.nearest(lost, network, within / 10, within / 5))
    rest = lost.join(close.select(F.col("ref_id").alias("id")), "id", "left_anti")
    far = close.unionByName(blocking.nearest(rest, network, within, within)).select(F.col("ref_id").alias("id"), F.col("distance").alias("nearest_m"))
    m = g.length(F.col("xy"))
    marked = lost.select("id", F.when(m > 50, "high").when(m > 10, "medium").otherwise("low").alias("priority"))
    return marked.join(own, "id").join(size, "component").join(far, "id", "left").select("id", "component", "n", "nearest_m", "priority")
