"""Line geometry as Column expressions over ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>, all JVM-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once a row, however often body uses it; lambdas share no subexpressions otherwise."""
    return F.element_at(F.transform(F.array(value), body), 1)


def point(x: Column | float, y: Column | float) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.struct(lit(x).cast("double").alias("x"), lit(y).cast("double").alias("y"))


def distance(a: Column, b: Column) -> Column:
    """Between two points."""
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def pieces(xy: Column) -> Column:
    """The straight pieces of a line: ARRAY<STRUCT<a, b>>."""
    return let(xy, lambda v: F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def length(xy: Column) -> Column:
    return total(F.transform(pieces(xy), lambda p: distance(p["a"], p["b"])))


def first(xy: Column) -> Column:
    return F.element_at(xy, 1)


def last(xy: Column) -> Column:
    return F.element_at(xy, -1)


def bearing(a: Column, b: Column) -> Column:
    """Degrees of the direction from a to b, in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(b["y"] - a["y"], b["x"] - a["x"])), F.lit(360.0))


def heading(xy: Column) -> Column:
    return bearing(first(xy), last(xy))


def heading_delta(h1: Column, h2: Column) -> Column:
    """Undirected difference of two headings, folded to [0, 90]."""
    d = F.pmod(F.abs(h1 - h2), F.lit(180.0))
    return F.least(d, 180.0 - d)


def midpoint(xy: Column) -> Column:
    return let(xy, lambda v: interpolate(v, length(v) / 2))


def along(p: Column, a: Column, b: Column) -> Column:
    """Clamped parameter in [0, 1] of the point of segment ab nearest to p."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    norm = dx * dx + dy * dy
    t = ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / F.when(norm > 0, norm)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))


def at(a: Column, b: Column, t: Column) -> Column:
    return point(a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"]))


def distance_to_line(p: Column, xy: Column) -> Column:
    return let(p, lambda q: _to_pieces(q, pieces(xy)))


def distances_to_line(points: Column, xy: Column) -> Column:
    """The distance of each of some points to a line."""
    return let(pieces(xy), lambda s: F.transform(points, lambda p: _to_pieces(p, s)))


def _to_pieces(p: Column, parts: Column) -> Column:
    return F.array_min(F.transform(parts, lambda s: let(along(p, s["a"], s["b"]), lambda t: distance(p, at(s["a"], s["b"], t)))))


def measured(xy: Column) -> Column:
    """Pieces with their start measure and length: ARRAY<STRUCT<a, b, m, n>>."""
    zero = F.struct(F.lit(0.0).alias("upto"), F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>,m:double,n:double>>").alias("out"))

    def grown(s: Column, p: Column, n: Column) -> Column:
        return F.struct((s["upto"] + n).alias("upto"), F.concat(s["out"], F.array(F.struct(p["a"].alias("a"), p["b"].alias("b"), s["upto"].alias("m"), n.alias("n")))).alias("out"))

    def add(s: Column, p: Column) -> Column:
        return let(distance(p["a"], p["b"]), lambda n: grown(s, p, n))

    return F.aggregate(pieces(xy), zero, add, lambda s: s["out"])


def project(p: Column, xy: Column) -> Column:
    """STRUCT<d, f>: least distance of p to the line and the fraction of the line where it is taken."""

    def one(q: Column, s: Column, whole: Column) -> Column:
        return let(along(q, s["a"], s["b"]), lambda t: F.struct(distance(q, at(s["a"], s["b"], t)).alias("d"), ((s["m"] + t * s["n"]) / F.when(whole > 0, whole)).alias("f")))

    return let(xy, lambda v: let(p, lambda q: let(length(v), lambda whole: F.array_min(F.transform(measured(v), lambda s: one(q, s, whole))))))


def interpolate(xy: Column, metres: Column) -> Column:
    """The point at a distance along the line, clamped to its ends."""
    return let(xy, lambda v: _place(measured(v), last(v), metres))


def _place(parts: Column, end: Column, metres: Column) -> Column:
    """interpolate() of a line's measured pieces and its last point."""
    hit = lambda m: F.get(F.filter(parts, lambda s: (s["m"] + s["n"] >= m) & (s["n"] > 0)), F.lit(0))
    on = lambda s, m: F.when(s.isNotNull(), at(s["a"], s["b"], (m - s["m"]) / s["n"]))
    return let(F.greatest(F.lit(0.0), metres), lambda m: F.coalesce(let(hit(m), lambda s: on(s, m)), end))


def sub_line(xy: Column, start: Column, end: Column) -> Column:
    """The part between two fractions (clamped, swapped if reversed); null where nothing is left."""
    lo = F.greatest(F.lit(0.0), F.least(start, end, F.lit(1.0)))
    hi = F.least(F.lit(1.0), F.greatest(start, end, F.lit(0.0)))

    def cut(v: Column, parts: Column, c: Column) -> Column:
        inner = F.transform(F.filter(parts, lambda s: (s["m"] > c["lo"]) & (s["m"] < c["hi"])), lambda s: s["a"])
        return F.concat(F.array(_place(parts, last(v), c["lo"])), inner, F.array(_place(parts, last(v), c["hi"])))

    def whole(v: Column, n: Column) -> Column:
        return let(measured(v), lambda parts: let(F.struct((lo * n).alias("lo"), (hi * n).alias("hi")), lambda c: cut(v, parts, c)))

    return F.when(hi > lo, let(xy, lambda v: let(length(v), lambda n: whole(v, n))))


def spread(xy: Column, n: Column | int) -> Column:
    """n points from one end to the other at equal steps along the line."""
    count = n if isinstance(n, Column) else F.lit(n)

    def places(v: Column, k: Column, parts: Column, whole: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), k - 1), lambda i: _place(parts, last(v), whole * i / (k - 1)))

    return let(xy, lambda v: let(count, lambda k: let(measured(v), lambda parts: let(length(v), lambda whole: places(v, k, parts, whole)))))


def samples(xy: Column, step: float, least: int = 2) -> Column:
    """Points about every `step` metres from one end to the other."""
    return let(xy, lambda v: spread(v, F.greatest(F.lit(least), F.floor(length(v) / step).cast("int"))))


def hausdorff(a: Column, b: Column) -> Column:
    """Discrete Hausdorff distance: vertices of each line to the other line."""
    return F.greatest(F.array_max(distances_to_line(a, b)), F.array_max(distances_to_line(b, a)))


def vertex_distances(a: Column, b: Column) -> Column:
    return F.concat(distances_to_line(a, b), distances_to_line(b, a))


def mean(values: Column) -> Column:
    return let(values, lambda v: total(v) / F.when(F.size(v) > 0, F.size(v)))


def percentile(values: Column, q: float) -> Column:
    """Linear percentile of an array."""

    def between(s: Column, place: Column) -> Column:
        lo, hi = F.floor(place).cast("int"), F.ceil(place).cast("int")
        return F.when(F.size(s) > 0, F.get(s, lo) + (place - lo) * (F.get(s, hi) - F.get(s, lo)))

    return let(F.array_sort(values), lambda s: let((F.size(s) - 1) * F.lit(q), lambda place: between(s, place)))


def sinuosity(xy: Column) -> Column:
    """Length over chord; null for loops, 1 for lines without length."""
    of = lambda chord, n: F.when(n <= 0, 1.0).when(chord > 1e-9, n / F.when(chord > 1e-9, chord))
    return let(xy, lambda v: let(distance(first(v), last(v)), lambda chord: let(length(v), lambda n: of(chord, n))))


def turns(xy: Column) -> Column:
    """Absolute turn angles at inner vertices, in degrees."""

    def turn(a: Column, b: Column) -> Column:
        return let(F.pmod(F.abs(bearing(a["a"], a["b"]) - bearing(b["a"], b["b"])), F.lit(360.0)), lambda d: F.least(d, 360.0 - d))

    n = lambda p: F.greatest(F.size(p) - 1, F.lit(0))
    return let(pieces(xy), lambda p: F.zip_with(F.slice(p, 1, n(p)), F.slice(p, 2, n(p)), turn))


def bbox(xy: Column) -> Column:
    xs, ys = F.transform(xy, lambda p: p["x"]), F.transform(xy, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def shoelace(xy: Column) -> Column:
    """Area of the ring that the vertices make."""
    closed = F.concat(xy, F.array(first(xy)))
    return F.abs(total(F.transform(pieces(closed), lambda p: p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]))) / 2


def line_distance(a: Column, b: Column) -> Column:
    """Least distance of two lines: 0 if pieces cross, else the least endpoint distance."""

    def side(p: Column, q: Column, r: Column) -> Column:
        return (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])

    def crossed(s: Column, t: Column) -> Column:
        return (side(s["a"], s["b"], t["a"]) * side(s["a"], s["b"], t["b"]) < 0) & (side(t["a"], t["b"], s["a"]) * side(t["a"], t["b"], s["b"]) < 0)

    crossing = let(pieces(b), lambda others: F.exists(pieces(a), lambda s: F.exists(others, lambda t: crossed(s, t))))
    return F.when(crossing, 0.0).otherwise(F.array_min(vertex_distances(a, b)))


def capsule(s: Column, t: Column, radius: float) -> Column:
    """STRUCT<lo, hi>, the parameters of piece s within a radius of piece t, or null."""
    r = F.lit(float(radius))
    # interval of piece s (parameter 0..1) within r of piece t: hull of the two end discs and the slab
    dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
    n2 = F.nullif(dx * dx + dy * dy, F.lit(0.0))

    def disc(c: Column) -> Column:
        fx, fy = s["a"]["x"] - c["x"], s["a"]["y"] - c["y"]
        b = fx * dx + fy * dy
        q = b * b - n2 * (fx * fx + fy * fy - r * r)
        root = F.sqrt(F.when(q >= 0, q))
        return F.struct(((-b - root) / n2).alias("lo"), ((-b + root) / n2).alias("hi"))

    ux, uy = t["b"]["x"] - t["a"]["x"], t["b"]["y"] - t["a"]["y"]
    m = F.nullif(F.sqrt(ux * ux + uy * uy), F.lit(0.0))
    ax, ay = s["a"]["x"] - t["a"]["x"], s["a"]["y"] - t["a"]["y"]
    along0, along1 = (ax * ux + ay * uy) / m, (dx * ux + dy * uy) / m
    off0, off1 = (ax * uy - ay * ux) / m, (dx * uy - dy * ux) / m

    def slab(v0: Column, v1: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
        p, q = (lo - v0) / F.when(v1 != 0, v1), (hi - v0) / F.when(v1 != 0, v1)
        inside = (v0 >= lo) & (v0 <= hi)
        a = F.when(v1 == 0, F.when(inside, F.lit(0.0)).otherwise(F.lit(2.0))).otherwise(F.least(p, q))
        b = F.when(v1 == 0, F.when(inside, F.lit(1.0)).otherwise(F.lit(-1.0))).otherwise(F.greatest(p, q))
        return a, b

    a1, b1 = slab(along0, along1, F.lit(0.0), m)
    a2, b2 = slab(off0, off1, -r, r)
    box = F.struct(F.greatest(a1, a2).alias("lo"), F.least(b1, b2).alias("hi"))
    parts = F.filter(F.array(disc(t["a"]), disc(t["b"]), box), lambda z: z["lo"].isNotNull() & (z["lo"] <= z["hi"]) & (z["hi"] > 0) & (z["lo"] < 1))
    return F.when((n2 > 0) & (F.size(parts) > 0), F.struct(
        F.greatest(F.lit(0.0), F.array_min(F.transform(parts, lambda z: z["lo"]))).alias("lo"),
        F.least(F.lit(1.0), F.array_max(F.transform(parts, lambda z: z["hi"]))).alias("hi"),
    ))


def within(xy: Column, other: Column, radius: float) -> Column:
    """Metres of a line within `radius` of another (round caps): exact, by merged capsule intervals."""

    def one(s: Column) -> Column:
        spans = F.array_sort(F.filter(F.transform(pieces(other), lambda t: capsule(s, t, radius)), lambda z: z.isNotNull()))
        return union_length(spans) * distance(s["a"], s["b"])

    return total(F.transform(pieces(xy), one))


def within_spans(xy: Column, other: Column, radius: float) -> Column:
    """ARRAY<STRUCT<start, end>>: fractions of a line within `radius` of pieces of another, unmerged."""
    whole = F.nullif(length(xy), F.lit(0.0))

    def one(s: Column) -> Column:
        spans = F.filter(F.transform(pieces(other), lambda t: capsule(s, t, radius)), lambda z: z.isNotNull())
        return F.transform(spans, lambda z: F.struct(((s["m"] + z["lo"] * s["n"]) / whole).alias("start"), ((s["m"] + z["hi"] * s["n"]) / whole).alias("end")))

    return F.flatten(F.transform(measured(xy), one))


def union_length(spans: Column) -> Column:
    """Measure of the union of sorted ARRAY<STRUCT<lo, hi>>."""
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(-1e300).alias("end"))

    def add(s: Column, z: Column) -> Column:
        return F.struct((s["sum"] + F.greatest(F.lit(0.0), z["hi"] - F.greatest(z["lo"], s["end"]))).alias("sum"), F.greatest(s["end"], z["hi"]).alias("end"))

    return F.aggregate(spans, zero, add, lambda s: s["sum"])


def cells(box: Column, size: float, pad: float = 0.0) -> Column:
    """Keys of the square grid cells that a padded box touches: ARRAY<STRUCT<cx, cy>>."""
    lo = lambda v: F.floor((v - pad) / size).cast("bigint")
    hi = lambda v: F.floor((v + pad) / size).cast("bigint")
    return F.flatten(
        F.transform(F.sequence(lo(box["xmin"]), hi(box["xmax"])), lambda cx: F.transform(F.sequence(lo(box["ymin"]), hi(box["ymax"])), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))))
    )


def snap_cell(v: Column, size: float) -> Column:
    """Nearest grid index, halves to even."""
    return F.rint(v / size).cast("bigint")


def length_bin(metres: Column) -> Column:
    """0, 1, 2 or 3 for lengths under 10, under 100, under 500 and of 500 metres and more."""
    return F.when(metres < 10, 0).when(metres < 100, 1).when(metres < 500, 2).otherwise(3)


# The WGS 84 ellipsoid.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563


def geodesic(a: Column, b: Column) -> Column:
    """Metres between two points of degrees (x east, y north) on the ellipsoid, by Lambert's formula (errors of about 10 m in thousands of km)."""
    rad = F.radians
    beta = lambda p: F.atan((1 - FLATTENING) * F.tan(rad(p["y"])))
    p, q = (beta(a) + beta(b)) / 2, (beta(b) - beta(a)) / 2
    h = F.pow(F.sin(q), 2) + F.cos(beta(a)) * F.cos(beta(b)) * F.pow(F.sin(rad(b["x"] - a["x"]) / 2), 2)
    angle = 2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
    x = (angle - F.sin(angle)) * F.pow(F.sin(p) * F.cos(q) / F.cos(angle / 2), 2)
    y = (angle + F.sin(angle)) * F.pow(F.cos(p) * F.sin(q) / F.sin(angle / 2), 2)
    return F.when(h == 0, 0.0).otherwise(AXIS * (angle - FLATTENING / 2 * (x + y)))


def geodesic_length(xy: Column) -> Column:
    return total(F.transform(pieces(xy), lambda s: geodesic(s["a"], s["b"])))


def merged_parts(parts: Column) -> Column:
    """One line of a multi-part line ARRAY<ARRAY<point>>: parts that follow end to end are joined, of what stays apart the longest is kept.

    Parts may run either way; the first in order wins ties. Null for no parts.
    """
    n = F.size(parts)
    kind = "array<struct<x:double,y:double>>"
    one = lambda line, rest, done: F.struct(line.alias("line"), rest.alias("rest"), done.alias("done"))
    start = one(F.get(parts, F.lit(0)), F.slice(parts, 2, F.greatest(n - 1, F.lit(0))), F.array().cast(f"array<{kind}>"))

    def fits(line: Column, p: Column) -> Column:
        return (first(p) == last(line)) | (last(p) == last(line)) | (first(p) == first(line)) | (last(p) == first(line))

    def joined(line: Column, p: Column) -> Column:
        tail = lambda q: F.slice(q, 2, F.size(q) - 1)
        return (
            F.when(first(p) == last(line), F.concat(line, tail(p))).when(last(p) == last(line), F.concat(line, tail(F.reverse(p))))
            .when(first(p) == first(line), F.concat(F.reverse(p), tail(line))).otherwise(F.concat(p, tail(line)))
        )

    def step(s: Column, _: Column) -> Column:
        line, rest, done = s["line"], s["rest"], s["done"]
        at = F.filter(F.transform(rest, lambda p, i: F.when(fits(line, p), i)), lambda i: i.isNotNull())
        grown = lambda i: one(let(F.get(rest, i), lambda p: joined(line, p)), F.filter(rest, lambda p, j: j != i), done)
        fresh = one(F.get(rest, F.lit(0)), F.slice(rest, 2, F.greatest(F.size(rest) - 1, F.lit(0))), F.array_append(done, line))
        return F.when(F.size(rest) == 0, s).otherwise(let(F.get(at, F.lit(0)), lambda i: F.when(i.isNotNull(), grown(i)).otherwise(fresh)))

    lines = let(F.aggregate(F.slice(parts, 2, F.greatest(n - 1, F.lit(0))), start, step), lambda whole: F.array_append(whole["done"], whole["line"]))
    best = F.array_max(F.transform(lines, lambda p, i: F.struct(length(p).alias("m"), (-i).alias("i"), p.alias("p"))))
    return F.when(n > 0, best["p"])
