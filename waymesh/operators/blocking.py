"""Spatial joins by grid cells: an equi-join on cells touched, then the exact predicate.

Every pair is reported by one cell only, the one that holds the lower left corner of the boxes'
overlap, so no distinct is needed after the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g


def box_join(left: DataFrame, right: DataFrame, pad: float, cell: float = 100.0, left_prefix: str = "ref_", right_prefix: str = "target_") -> DataFrame:
    """Pairs of rows whose boxes, the right one padded, overlap. Both sides have an xy column; columns are prefixed."""
    l = left.select(*[F.col(c).alias(left_prefix + c) for c in left.columns], g.bbox(F.col("xy")).alias("__lb"))  # noqa: E741
    r = right.select(*[F.col(c).alias(right_prefix + c) for c in right.columns], g.bbox(F.col("xy")).alias("__rb"))
    l = l.withColumn("__cell", F.explode(g.cells(F.col("__lb"), cell)))  # noqa: E741
    r = r.withColumn("__cell", F.explode(g.cells(F.col("__rb"), cell, pad)))
    lb, rb = F.col("__lb"), F.col("__rb")
    x, y = F.greatest(lb["xmin"], rb["xmin"] - pad), F.greatest(lb["ymin"], rb["ymin"] - pad)
    here = (F.floor(x / cell) == F.col("__cell.cx")) & (F.floor(y / cell) == F.col("__cell.cy"))
    overlap = (lb["xmin"] <= rb["xmax"] + pad) & (lb["xmax"] >= rb["xmin"] - pad) & (lb["ymin"] <= rb["ymax"] + pad) & (lb["ymax"] >= rb["ymin"] - pad)
    return l.join(r, "__cell").filter(overlap & here).drop("__cell", "__lb", "__rb")


def candidates(ref: DataFrame, target: DataFrame, metres: float = 50.0, cell: float = 100.0) -> DataFrame:
    """Pairs within `metres`, with distance_estimate (of midpoints), heading_diff and line distance."""
    r, t = with_pieces(ref.select("id", "xy")), with_pieces(target.select("id", "xy"))
    pairs = box_join(r.withColumn("c", centre(F.col("xy"))), t.withColumn("c", centre(F.col("xy"))), metres, cell)
    pairs = pairs.withColumns({"heading_diff": g.heading_delta(F.col("ref_h"), F.col("target_h")), "distance_estimate": g.distance(F.col("ref_c"), F.col("target_c"))})
    return line_distances(pairs, ["ref_id", "target_id", "heading_diff", "distance_estimate"]).filter(F.col("distance") <= metres)


def centre(xy: Column) -> Column:
    """Centroid of a line: its pieces' midpoints weighted by length."""
    side = lambda c: g.total(F.transform(g.pieces(xy), lambda s: (s["a"][c] + s["b"][c]) / 2 * g.distance(s["a"], s["b"])))
    return g.let(g.length(xy), lambda n: F.when(n > 0, g.point(side("x") / F.when(n > 0, n), side("y") / F.when(n > 0, n))).otherwise(g.first(xy)))


def endpoints(rows: DataFrame) -> DataFrame:
    """id, which (0 start, 1 end), p."""
    ends = F.array(g.first(F.col("xy")), g.last(F.col("xy")))
    return rows.select("id", F.posexplode(ends).alias("which", "p"))


def point_join(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Pairs of points (column p) within a distance; right columns are prefixed r_."""
    cx, cy = F.floor(F.col("p.x") / metres), F.floor(F.col("p.y") / metres)
    r = right.select(*[F.col(c).alias("r_" + c) for c in right.columns]).withColumns({"__x": F.floor(F.col("r_p.x") / metres), "__y": F.floor(F.col("r_p.y") / metres)})
    step = F.array(*[F.lit(v) for v in (-1, 0, 1)])
    l = left.withColumn("__dx", F.explode(step)).withColumn("__dy", F.explode(step)).withColumns({"__x": cx + F.col("__dx"), "__y": cy + F.col("__dy")})  # noqa: E741
    return l.join(r, ["__x", "__y"]).withColumn("d", g.distance(F.col("p"), F.col("r_p"))).filter(F.col("d") <= metres).drop("__x", "__y", "__dx", "__dy")


def endpoint_pairs(rows: DataFrame, metres: float) -> DataFrame:
    """Pairs of endpoints of different segments within a distance, each once."""
    e = endpoints(rows)
    return point_join(e, e, metres).filter((F.col("id") < F.col("r_id")))


def point_line_join(points: DataFrame, lines: DataFrame, metres: float, cell: float = 100.0) -> DataFrame:
    """Points (id, p) with lines (line_*) within a distance: d and fraction f along the line."""
    dots = points.withColumn("xy", F.array("p", "p"))
    pairs = box_join(lines, dots, metres, cell, "line_", "")
    return pairs.withColumn("__at", g.project(F.col("p"), F.col("line_xy"))).withColumns({"d": F.col("__at.d"), "f": F.col("__at.f")}).drop("__at", "xy").filter(F.col("d") <= metres)


def nearest(left: DataFrame, right: DataFrame, metres: float, cell: float = 100.0) -> DataFrame:
    """For each left row, the nearest right row within a distance (ties: smaller id)."""
    pairs = box_join(with_pieces(left.select("id", "xy")), with_pieces(right.select("id", "xy")), metres, cell)
    pairs = line_distances(pairs, ["ref_id", "target_id"]).filter(F.col("distance") <= metres)
    return pairs.groupBy("ref_id").agg(F.min(F.struct("distance", "target_id")).alias("m")).select("ref_id", F.col("m.target_id").alias("target_id"), F.col("m.distance").alias("distance"))


def with_pieces(rows: DataFrame) -> DataFrame:
    """rows with parts (pieces with their start measure), n (length) and h (heading), computed once a row, before any join."""
    xy = F.col("xy")
    return rows.withColumns({"parts": g.measured(xy), "n": g.length(xy), "h": g.heading(xy)})


def piece_pairs(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per pair of pieces of the two lines of a pair, with flat coordinates (a-b against c-e), so that what follows is generated code."""
    flat = pairs.select(*keys, F.explode("ref_parts").alias("s"), "target_parts").select(*keys, "s", F.explode("target_parts").alias("t"))
    return flat.select(
        *keys, F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"), F.col("s.m").alias("m"), F.col("s.n").alias("n"),
        F.col("t.a.x").alias("cx"), F.col("t.a.y").alias("cy"), F.col("t.b.x").alias("ex"), F.col("t.b.y").alias("ey"), F.col("t.n").alias("tn"),
    )


def line_distances(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys and distance: least distance of the two lines of each pair (0 where pieces cross)."""
    c = F.col

    def to_piece(px: str, py: str, x0: str, y0: str, x1: str, y1: str) -> Column:
        dx, dy = c(x1) - c(x0), c(y1) - c(y0)
        t = F.coalesce(((c(px) - c(x0)) * dx + (c(py) - c(y0)) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        ux, uy = c(px) - (c(x0) + t * dx), c(py) - (c(y0) + t * dy)
        return ux * ux + uy * uy

    def side(x0: str, y0: str, x1: str, y1: str, px: str, py: str) -> Column:
        return (c(x1) - c(x0)) * (c(py) - c(y0)) - (c(y1) - c(y0)) * (c(px) - c(x0))

    s, t = ("ax", "ay", "bx", "by"), ("cx", "cy", "ex", "ey")
    crossed = (side(*s, "cx", "cy") * side(*s, "ex", "ey") < 0) & (side(*t, "ax", "ay") * side(*t, "bx", "by") < 0)
    near = F.least(to_piece("ax", "ay", *t), to_piece("bx", "by", *t), to_piece("cx", "cy", *s), to_piece("ex", "ey", *s))
    return piece_pairs(pairs, keys).groupBy(*keys).agg(F.sqrt(F.min(F.when(crossed, 0.0).otherwise(near))).alias("distance"))


def capsule_rows(pairs: DataFrame, keys: list[str], metres: float) -> DataFrame:
    """keys, start, end: measures along the reference line within `metres` of a piece of the other line, unmerged; nulls where there are none.

    A piece meets a piece's capsule in one interval: the hull of what it has in both end discs and in the slab between.
    Rows without an interval stay, as a filter here would be pushed down and repeat all of these expressions.
    """
    r2, c = metres * metres, F.col
    p = piece_pairs(pairs, keys).filter("n > 0")
    p = p.withColumns({"dx": c("bx") - c("ax"), "dy": c("by") - c("ay"), "ux": (c("ex") - c("cx")) / F.nullif("tn", F.lit(0.0)), "uy": (c("ey") - c("cy")) / F.nullif("tn", F.lit(0.0))})

    def disc(x: str, y: str, lo: str, hi: str) -> dict[str, Column]:
        fx, fy = c("ax") - c(x), c("ay") - c(y)
        b = (fx * c("dx") + fy * c("dy")) / c("n")
        q = b * b - (fx * fx + fy * fy - r2)
        root = F.sqrt(F.when(q >= 0, q))
        return {lo: (-b - root) / c("n"), hi: (-b + root) / c("n")}

    p = p.withColumns(disc("cx", "cy", "l1", "h1") | disc("ex", "ey", "l2", "h2"))
    fx, fy = c("ax") - c("cx"), c("ay") - c("cy")
    p = p.withColumns({"v0": fx * c("ux") + fy * c("uy"), "v1": c("dx") * c("ux") + c("dy") * c("uy"), "w0": fx * c("uy") - fy * c("ux"), "w1": c("dx") * c("uy") - c("dy") * c("ux")})

    def slab(v0: str, v1: str, lo: Column, hi: Column) -> tuple[Column, Column]:
        a, b = (lo - c(v0)) / F.nullif(v1, F.lit(0.0)), (hi - c(v0)) / F.nullif(v1, F.lit(0.0))
        inside = (c(v0) >= lo) & (c(v0) <= hi)
        return F.when(c(v1) == 0, F.when(inside, 0.0).otherwise(2.0)).otherwise(F.least(a, b)), F.when(c(v1) == 0, F.when(inside, 1.0).otherwise(-1.0)).otherwise(F.greatest(a, b))

    a1, b1 = slab("v0", "v1", F.lit(0.0), c("tn"))
    a2, b2 = slab("w0", "w1", F.lit(-metres), F.lit(metres))
    p = p.withColumns({"l3": F.greatest(a1, a2), "h3": F.least(b1, b2)})
    use = [(lo, hi, c(lo).isNotNull() & (c(lo) <= c(hi)) & (c(hi) > 0) & (c(lo) < 1)) for lo, hi in (("l1", "h1"), ("l2", "h2"), ("l3", "h3"))]
    lo = F.least(*[F.when(ok, c(x)) for x, _, ok in use])
    hi = F.greatest(*[F.when(ok, c(y)) for _, y, ok in use])
    out = p.withColumns({"lo": lo, "hi": hi}).withColumns({"from": F.when(c("lo").isNotNull(), F.greatest("lo", F.lit(0.0))), "to": F.when(c("lo").isNotNull(), F.least("hi", F.lit(1.0)))})
    return out.select(*keys, (c("m") + c("from") * c("n")).alias("start"), (c("m") + c("to") * c("n")).alias("end"))


def overlaps(pairs: DataFrame, keys: list[str], metres: float) -> DataFrame:
    """keys and overlap_m: metres of the reference line within `metres` of the other lines of a key (one or several)."""
    span = F.when(F.col("start").isNotNull(), F.struct(F.col("start").alias("lo"), F.col("end").alias("hi")))
    spans = capsule_rows(pairs, keys, metres).groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("z"))
    return spans.select(*keys, g.union_length(F.col("z")).alias("overlap_m"))
