"""Spatial joins, pair features and matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import blocking, matching
from ..sources import synthetic as s
from . import sqltext as q
from .registry import query

R, T = s.reference, s.target


def both(spark, d, pad):
    return blocking.box_join(R(spark, d), T(spark, d), pad)




def A():
    return F.col("ref_xy")


def B():
    return F.col("target_xy")



@query("q001_segment_scan", q.with_tables(f"SELECT id, class, len(xy) AS n_vertices, round({q.length('xy')}, 6) AS length_m FROM ref"))
def segment_scan(spark, d):
    return R(spark, d).filter(F.col("xy").isNotNull()).select("id", "class", F.size("xy").cast("long").alias("n_vertices"), F.round(g.length(F.col("xy")), 6).alias("length_m"))


@query("q058_bbox_containment", q.with_tables(f"SELECT id FROM ref WHERE {q.bbox('xy', 'min', 'x')} >= 200 AND {q.bbox('xy', 'max', 'x')} <= 900 AND {q.bbox('xy', 'min', 'y')} >= 200 AND {q.bbox('xy', 'max', 'y')} <= 900"))
def bbox_containment(spark, d):
    b = g.bbox(F.col("xy"))
    return R(spark, d).filter((b["xmin"] >= 200) & (b["xmax"] <= 900) & (b["ymin"] >= 200) & (b["ymax"] <= 900)).select("id")


@query("q013_bbox_expand", q.with_tables(f"SELECT round(min({q.bbox('xy', 'min', 'x')}) - 50, 6) AS xmin, round(min({q.bbox('xy', 'min', 'y')}) - 50, 6) AS ymin, round(max({q.bbox('xy', 'max', 'x')}) + 50, 6) AS xmax, round(max({q.bbox('xy', 'max', 'y')}) + 50, 6) AS ymax FROM ref"))
def bbox_expand(spark, d):
    b = R(spark, d).select(g.bbox(F.col("xy")).alias("b"))
    return b.agg(*[F.round(f(f"b.{c}") + pad, 6).alias(c) for c, f, pad in (("xmin", F.min, -50), ("ymin", F.min, -50), ("xmax", F.max, 50), ("ymax", F.max, 50))])


@query("q010_bbox_pruned_scan", q.with_tables(f"SELECT id, class FROM ref WHERE {q.bbox('xy', 'min', 'x')} <= 500 AND {q.bbox('xy', 'max', 'x')} >= 100 AND {q.bbox('xy', 'min', 'y')} <= 500 AND {q.bbox('xy', 'max', 'y')} >= 100"))
def bbox_pruned_scan(spark, d):
    b = g.bbox(F.col("xy"))
    return R(spark, d).filter((b["xmin"] <= 500) & (b["xmax"] >= 100) & (b["ymin"] <= 500) & (b["ymax"] >= 100)).select("id", "class")


@query("q056_short_segments", q.with_tables(f"SELECT {q.length('xy')} >= 12 AS kept, count(*) AS n FROM ref GROUP BY 1"))
def short_segments(spark, d):
    return R(spark, d).groupBy((g.length(F.col("xy")) >= 12).alias("kept")).agg(F.count("*").alias("n"))


@query("q067_grid_distance_join", q.with_tables(f"SELECT ref_id, target_id, round({q.heading_delta('a', 'b')}, 6) AS heading_diff, round({q.line_distance('a', 'b')}, 6) AS distance FROM pairs WHERE {q.line_distance('a', 'b')} <= 30", q.pairs(30)))
def grid_distance_join(spark, d):
    c = blocking.candidates(R(spark, d), T(spark, d), 30.0)
    return c.select("ref_id", "target_id", F.round("heading_diff", 6).alias("heading_diff"), F.round("distance", 6).alias("distance"))


@query("q068_bbox_join", q.with_tables("SELECT ref_id, target_id FROM pairs", q.pairs(20)))
def bbox_join(spark, d):
    return both(spark, d, 20.0).select("ref_id", "target_id")


@query("q069_ids_then_semi_join", q.with_tables("SELECT id, class FROM ref WHERE id IN (SELECT ref_id FROM pairs)", q.pairs(20)))
def ids_then_semi_join(spark, d):
    ids = both(spark, d, 20.0).select(F.col("ref_id").alias("id")).distinct()
    return R(spark, d).join(ids, "id", "left_semi").select("id", "class")


@query("q070_cardinality_estimate")
def cardinality_estimate(spark, d):
    t = T(spark, d)
    part = t.orderBy(F.xxhash64("id")).limit(100)
    pairs = blocking.box_join(R(spark, d), part, 20.0).agg(F.count("*").alias("pairs"))
    return pairs.crossJoin(t.agg(F.count("*").alias("n"))).select((F.col("pairs") * F.col("n") / F.least(F.lit(100), F.col("n"))).alias("estimate"))


@query("q071_physical_overlap_filter")
def physical_overlap_filter(spark, d):
    p = blocking.box_join(blocking.with_pieces(R(spark, d).select("id", "xy")), blocking.with_pieces(T(spark, d).select("id", "xy")), 5.0)
    p = blocking.overlaps(p, ["ref_id", "target_id", "ref_n", "target_n"], 5.0)
    least = F.greatest(F.lit(1.0), F.least(F.lit(5.0), 0.5 * F.least("ref_n", "target_n")))
    return p.filter(F.col("overlap_m") >= least).select("ref_id", "target_id", F.round("overlap_m", 6).alias("overlap"))


@query("q073_nearest_neighbour", q.with_tables(f"SELECT ref_id, arg_min(target_id, (dd, target_id)) AS target_id, round(min(dd), 6) AS distance FROM (SELECT *, {q.line_distance('a', 'b')} AS dd FROM pairs) WHERE dd <= 60 GROUP BY ref_id", q.pairs(60)))
def nearest_neighbour(spark, d):
    return blocking.nearest(R(spark, d), T(spark, d), 60.0).withColumn("distance", F.round("distance", 6))


ENDS = "ends AS (SELECT id, 0 AS which, xy[1].x AS x, xy[1].y AS y FROM ref UNION ALL SELECT id, 1, xy[-1].x, xy[-1].y FROM ref)"


@query("q076_endpoint_self_join", q.with_tables(f"SELECT a.id AS id, a.which AS which, b.id AS r_id, b.which AS r_which, round({q.dist('a.x', 'a.y', 'b.x', 'b.y')}, 6) AS d FROM ends a JOIN ends b ON a.id < b.id AND abs(a.x - b.x) <= 12 AND {q.dist('a.x', 'a.y', 'b.x', 'b.y')} <= 12", ENDS))
def endpoint_self_join(spark, d):
    return blocking.endpoint_pairs(R(spark, d), 12.0).select("id", "which", "r_id", "r_which", F.round("d", 6).alias("d"))


@query("q074_endpoint_radius_join", q.with_tables(f"SELECT t.id AS id, e.id AS r_id, e.which AS r_which, round({q.dist('t.xy[1].x', 't.xy[1].y', 'e.x', 'e.y')}, 6) AS d FROM tgt t JOIN ends e ON abs(t.xy[1].x - e.x) <= 10 AND {q.dist('t.xy[1].x', 't.xy[1].y', 'e.x', 'e.y')} <= 10", ENDS))
def endpoint_radius_join(spark, d):
    t = blocking.endpoints(T(spark, d)).filter("which = 0").select("id", "p")
    return blocking.point_join(t, blocking.endpoints(R(spark, d)), 10.0).select("id", "r_id", "r_which", F.round("d", 6).alias("d"))


@query("q075_segment_radius_join", q.with_tables(f"SELECT ref_id, target_id FROM pairs WHERE {q.line_distance('a', 'b')} <= 10", q.pairs(10)))
def segment_radius_join(spark, d):
    return both(spark, d, 10.0).filter(g.line_distance(A(), B()) <= 10).select("ref_id", "target_id")


@query("q072_radius_query", q.with_tables(f"SELECT id FROM ref WHERE {q.point_line('500', '500', 'xy')} <= 120"))
def radius_query(spark, d):
    return R(spark, d).filter(g.distance_to_line(g.point(500, 500), F.col("xy")) <= 120).select("id")


@query("q078_connector_projection", q.with_tables(f"SELECT t.id AS id, r.id AS line_id, round({q.point_line('t.xy[1].x', 't.xy[1].y', 'r.xy')}, 6) AS d FROM tgt t JOIN ref r ON {q.boxes_overlap('r.xy', '[t.xy[1]]', 5)} WHERE {q.point_line('t.xy[1].x', 't.xy[1].y', 'r.xy')} <= 5"))
def connector_projection(spark, d):
    t = T(spark, d).select("id", g.first(F.col("xy")).alias("p"))
    return blocking.point_line_join(t, R(spark, d).select("id", "xy"), 5.0).select("id", "line_id", F.round("d", 6).alias("d"))


@query("q077_anchor_road")
def anchor_road(spark, d):
    p = both(spark, d, 30.0).withColumns({"dist": g.line_distance(A(), B()), "align": F.cos(F.radians(g.heading_delta(g.heading(A()), g.heading(B()))))}).filter("align >= 0.7 AND dist <= 30")
    return p.groupBy("target_id").agg(F.max(F.struct((F.round(F.col("align") - F.col("dist") / 30, 9)).alias("v"), F.col("ref_id").alias("ref_id"))).alias("m")).select("target_id", "m.ref_id", F.col("m.v").alias("score"))


@query("q079_parallel_siblings")
def parallel_siblings(spark, d):
    r = blocking.with_pieces(R(spark, d).select("id", "name", "class", "xy"))
    named = (F.coalesce("ref_name", F.lit("")) != "") & (F.coalesce("target_name", F.lit("")) != "")
    alike = F.least(g.length(A()), g.length(B())) / F.greatest(g.length(A()), g.length(B())) >= 0.5
    p = blocking.box_join(r, r, 30.0).filter("ref_id <> target_id").filter(F.cos(F.radians(g.heading_delta(g.heading(A()), g.heading(B())))) >= 0.7)
    # cheap evidence first; a written table then keeps the line kernels from being computed for each of their uses
    p = p.filter(F.when(named, F.col("ref_name") == F.col("target_name")).otherwise((F.col("ref_class") == F.col("target_class")) & alike))
    p = matching.scratch(p.select("ref_id", "target_id", "ref_xy", "target_xy", "ref_parts", "target_parts", named.alias("named")))
    near = blocking.overlaps(p, ["ref_id", "target_id"], 30.0).select("ref_id", "target_id", "overlap_m")
    p = p.join(near, ["ref_id", "target_id"]).withColumn("fraction", F.col("overlap_m") / g.length(A())).filter((F.col("fraction") >= 0.3) & (F.col("named") | (F.col("fraction") >= 0.6)))
    offset = g.percentile(g.distances_to_line(g.samples(A(), 10.0, 3), B()), 0.25)
    p = matching.scratch(p.select("ref_id", "target_id", "fraction", offset.alias("offset"))).filter(F.col("offset").between(5, 30))
    best = p.groupBy("ref_id").agg(F.max(F.struct(F.round("fraction", 6).alias("fraction"), "target_id")).alias("m"))
    return best.select("ref_id", F.col("m.target_id").alias("sibling_id"), F.col("m.fraction").alias("fraction"))


TIER = "CASE {} WHEN 'motorway' THEN 0 WHEN 'primary' THEN 1 WHEN 'secondary' THEN 1 WHEN 'tertiary' THEN 2 WHEN 'residential' THEN 2 WHEN 'service' THEN 3 ELSE 4 END"


@query("q080_crossing_neighbours", q.with_tables(f"SELECT ref_id, round(min({q.heading_delta('a', 'b')}), 6) AS min_angle, avg(CASE WHEN {q.heading_delta('a', 'b')} > 60 THEN 1.0 ELSE 0.0 END) AS steep_share FROM (SELECT r.id AS ref_id, r.xy AS a, t.xy AS b FROM ref r JOIN ref t ON r.id <> t.id AND {q.boxes_overlap('r.xy', 't.xy', 15)} AND {TIER.format('r.class')} <> {TIER.format('t.class')}) WHERE {q.line_distance('a', 'b')} <= 15 GROUP BY ref_id"))
def crossing_neighbours(spark, d):
    tier = F.expr(TIER.format("class"))
    r = R(spark, d).select("id", tier.alias("tier"), "xy")
    p = blocking.box_join(r, r, 15.0).filter("ref_id <> target_id AND ref_tier <> target_tier").filter(g.line_distance(A(), B()) <= 15)
    p = p.withColumn("angle", g.heading_delta(g.heading(A()), g.heading(B())))
    return p.groupBy("ref_id").agg(F.round(F.min("angle"), 6).alias("min_angle"), F.avg(F.when(F.col("angle") > 60, 1.0).otherwise(0.0)).alias("steep_share"))


H = f"list_sort({q.vertex_distances('a', 'b')})"


@query(
    "q160_hausdorff_family",
    q.with_tables(f"SELECT ref_id, target_id, round(list_max(v), 6) AS hausdorff, round(list_sum(v) / len(v), 6) AS mean_hausdorff, round(quantile, 6) AS p95_hausdorff FROM (SELECT *, v[floor((len(v) - 1) * 0.95)::INT + 1] + ((len(v) - 1) * 0.95 - floor((len(v) - 1) * 0.95)) * (v[ceil((len(v) - 1) * 0.95)::INT + 1] - v[floor((len(v) - 1) * 0.95)::INT + 1]) AS quantile FROM (SELECT ref_id, target_id, {H} AS v FROM pairs))", q.pairs(10)),
)
def hausdorff_family(spark, d):
    v = F.col("v")
    p = both(spark, d, 10.0).select("ref_id", "target_id", g.vertex_distances(A(), B()).alias("v"))
    return p.select("ref_id", "target_id", F.round(F.array_max(v), 6).alias("hausdorff"), F.round(g.mean(v), 6).alias("mean_hausdorff"), F.round(g.percentile(v, 0.95), 6).alias("p95_hausdorff"))


@query("q162_edge_distance_rmse")
def edge_distance_rmse(spark, d):
    v = F.concat(g.distances_to_line(g.samples(A(), 5.0, 3), B()), g.distances_to_line(g.samples(B(), 5.0, 3), A()))
    return both(spark, d, 10.0).select("ref_id", "target_id", F.round(F.sqrt(g.mean(F.transform(v, lambda x: x * x))), 6).alias("rmse"))


@query("q164_overlap_lengths")
def overlap_lengths(spark, d):
    p = blocking.box_join(blocking.with_pieces(R(spark, d).select("id", "xy")), blocking.with_pieces(T(spark, d).select("id", "xy")), 15.0)
    keys = ["ref_id", "target_id", "ref_n"]
    wide = blocking.overlaps(p, keys, 15.0).withColumnRenamed("overlap_m", "wide")
    return wide.join(blocking.overlaps(p, keys, 5.0), keys, "left").select("ref_id", "target_id", F.round(F.coalesce("overlap_m", F.lit(0.0)), 6).alias("overlap_5"), F.round(F.col("wide") / F.col("ref_n"), 6).alias("overlap_ratio_15"))


@query("q166_heading_delta", q.with_tables(f"SELECT ref_id, target_id, round({q.heading_delta('a', 'b')}, 6) AS heading_delta FROM pairs", q.pairs(15)))
def heading_delta(spark, d):
    return both(spark, d, 15.0).select("ref_id", "target_id", F.round(g.heading_delta(g.heading(A()), g.heading(B())), 6).alias("heading_delta"))


@query("q170_sinuosity", q.with_tables(f"SELECT id, round({q.length('xy')} / {q.dist('xy[1].x', 'xy[1].y', 'xy[-1].x', 'xy[-1].y')}, 6) AS sinuosity FROM ref"))
def sinuosity(spark, d):
    return R(spark, d).select("id", F.round(g.sinuosity(F.col("xy")), 6).alias("sinuosity"))


@query("q169_shape_complexity", q.with_tables("""SELECT id, count(*) FILTER (least(t, 360 - t) > 10) AS n_turns FROM (SELECT id, CASE WHEN len(xy) = 3 THEN abs((degrees(atan2(xy[2].y - xy[1].y, xy[2].x - xy[1].x)) + 360) % 360 - (degrees(atan2(xy[3].y - xy[2].y, xy[3].x - xy[2].x)) + 360) % 360) END AS t FROM ref) GROUP BY id"""))
def shape_complexity(spark, d):
    return R(spark, d).select("id", F.size(F.filter(g.turns(F.col("xy")), lambda t: t > 10)).cast("long").alias("n_turns"))


@query("q172_vertex_density", q.with_tables(f"SELECT id, CASE WHEN {q.length('xy')} >= 1 THEN round(len(xy) / {q.length('xy')}, 6) END AS density, CASE WHEN {q.length('xy')} < 10 THEN '<10' WHEN {q.length('xy')} < 100 THEN '<100' WHEN {q.length('xy')} < 500 THEN '<500' ELSE '500+' END AS length_bin FROM ref"))
def vertex_density(spark, d):
    n = g.length(F.col("xy"))
    return R(spark, d).select("id", F.when(n >= 1, F.round(F.size("xy") / n, 6)).alias("density"), F.when(n < 10, "<10").when(n < 100, "<100").when(n < 500, "<500").otherwise("500+").alias("length_bin"))


@query("q168_angle_histogram")
def angle_histogram(spark, d):
    def bins(xy):
        of = lambda t: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda b: F.size(F.filter(t, lambda v: F.least(F.floor(v / 22.5), F.lit(7)) == b)) / F.size(t))
        return g.let(F.concat(F.array(F.lit(0.0)), g.turns(xy)), of)

    return both(spark, d, 10.0).select("ref_id", "target_id", F.round(g.total(F.zip_with(bins(A()), bins(B()), lambda x, y: F.least(x, y))), 6).alias("similarity"))


@query("q174_lateral_offset")
def lateral_offset(spark, d):
    v = F.col("v")
    p = both(spark, d, 10.0).select("ref_id", "target_id", g.distances_to_line(g.samples(B(), 5.0, 3), A()).alias("v"))
    return p.select("ref_id", "target_id", F.round(g.mean(v), 6).alias("mean"), F.round(g.percentile(v, 0.75) - g.percentile(v, 0.25), 6).alias("iqr"), F.round(g.percentile(v, 0.95), 6).alias("p95"))


@query("q171_heading_consistency")
def heading_consistency(spark, d):
    steps = g.let(g.samples(F.col("xy"), 10.0, 3), lambda p: F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), g.bearing))
    turn = g.let(steps, lambda s: F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: g.heading_delta(a, b)))
    return T(spark, d).select("id", F.round(1 - g.mean(turn) / 90, 6).alias("consistency"))


@query("q289_signed_offset")
def signed_offset(spark, d):
    a, b = g.first(A()), g.last(A())
    sign = lambda p: F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]))
    side = F.zip_with(B(), g.distances_to_line(B(), A()), lambda p, far: sign(p) * far)
    return both(spark, d, 10.0).select("ref_id", "target_id", F.round(g.mean(side), 6).alias("offset_m"))


@query("q155_sub_line", q.with_tables(f"SELECT id, round({q.length('[p, r]')}, 6) AS length_m FROM (SELECT id, {{'x': xy[1].x + 0.25 * (xy[2].x - xy[1].x), 'y': xy[1].y + 0.25 * (xy[2].y - xy[1].y)}} AS p, {{'x': xy[1].x + 0.75 * (xy[2].x - xy[1].x), 'y': xy[1].y + 0.75 * (xy[2].y - xy[1].y)}} AS r FROM ref WHERE len(xy) = 2)"))
def sub_line(spark, d):
    part = g.sub_line(F.col("xy"), F.lit(0.75), F.lit(0.25))
    return R(spark, d).filter(F.size("xy") == 2).select("id", F.round(g.length(part), 6).alias("length_m"))


@query("q156_interpolate", q.with_tables("SELECT id, round((xy[1].x + xy[2].x) / 2, 6) AS x, round((xy[1].y + xy[2].y) / 2, 6) AS y FROM ref WHERE len(xy) = 2"))
def interpolate(spark, d):
    m = g.midpoint(F.col("xy"))
    return R(spark, d).filter(F.size("xy") == 2).select("id", F.round(m["x"], 6).alias("x"), F.round(m["y"], 6).alias("y"))


@query("q157_project_point", q.with_tables(f"SELECT id, round({q.point_line('500.5', '400.25', 'xy')}, 6) AS d FROM ref"))
def project_point(spark, d):
    return R(spark, d).select("id", F.round(g.project(g.point(500.5, 400.25), F.col("xy"))["d"], 6).alias("d"))


@query("q158_coverage_and_alignment")
def coverage_and_alignment(spark, d):
    return matching.scored(R(spark, d), T(spark, d)).select("ref_id", "target_id", F.round(F.col("ref_to") - F.col("ref_from"), 6).alias("ref_coverage"), F.round(F.col("target_to") - F.col("target_from"), 6).alias("target_coverage"), F.round("overlap_m", 6).alias("aligned_length"), F.round(F.least("ref_length", "target_length"), 6).alias("min_length"))


@query("q176_offset_per_half_width", q.with_tables(f"SELECT ref_id, target_id, round(list_sum(v) / len(v) / ((CASE ref_class WHEN 'motorway' THEN 12 WHEN 'primary' THEN 8 ELSE 4 END + CASE target_class WHEN 'motorway' THEN 12 WHEN 'primary' THEN 8 ELSE 4 END) / 2.0 + 1e-6), 6) AS relative FROM (SELECT *, {q.vertex_distances('b', 'a')} AS v FROM pairs)", q.pairs(10)))
def offset_per_half_width(spark, d):
    w = lambda c: F.when(F.col(c) == "motorway", 12).when(F.col(c) == "primary", 8).otherwise(4)
    v = g.vertex_distances(B(), A())
    return both(spark, d, 10.0).select("ref_id", "target_id", F.round(g.mean(v) / ((w("ref_class") + w("target_class")) / F.lit(2.0) + 1e-6), 6).alias("relative"))


@query("q216_grid_snap", q.with_tables("SELECT id, CAST(round_even(xy[1].x / 5, 0) AS BIGINT) AS cx, CAST(round_even(xy[1].y / 5, 0) AS BIGINT) AS cy FROM ref"))
def grid_snap(spark, d):
    p = g.first(F.col("xy"))
    return R(spark, d).select("id", g.snap_cell(p["x"], 5.0).alias("cx"), g.snap_cell(p["y"], 5.0).alias("cy"))


@query("q060_spatial_id_suffix", q.with_tables("SELECT id, lower(hex(floor((xy[1].x + xy[-1].x) / 2 / 64)::BIGINT)) || '-' || lower(hex(floor((xy[1].y + xy[-1].y) / 2 / 64)::BIGINT)) AS suffix FROM ref WHERE len(xy) = 2 AND xy[1].x + xy[-1].x >= 0 AND xy[1].y + xy[-1].y >= 0"))
def spatial_id_suffix(spark, d):
    a, b = g.first(F.col("xy")), g.last(F.col("xy"))
    cell = lambda c: F.lower(F.hex(F.floor((a[c] + b[c]) / 2 / 64)))
    return R(spark, d).filter((F.size("xy") == 2) & (a["x"] + b["x"] >= 0) & (a["y"] + b["y"] >= 0)).select("id", F.concat_ws("-", cell("x"), cell("y")).alias("suffix"))


@query("q228_compactness", q.with_tables(f"SELECT id, round(abs((xy[1].x * xy[2].y - xy[2].x * xy[1].y) + (xy[2].x * xy[3].y - xy[3].x * xy[2].y) + (xy[3].x * xy[1].y - xy[1].x * xy[3].y)) / 2, 6) AS area, {q.dist('xy[1].x', 'xy[1].y', 'xy[-1].x', 'xy[-1].y')} <= 1 AS closed FROM ref WHERE len(xy) = 3"))
def compactness(spark, d):
    xy = F.col("xy")
    return R(spark, d).filter(F.size("xy") == 3).select("id", F.round(g.shoelace(xy), 6).alias("area"), (g.distance(g.first(xy), g.last(xy)) <= 1).alias("closed"))


@query("q269_naive_matcher")
def naive_matcher(spark, d):
    out = matching.naive(R(spark, d), T(spark, d))
    return out.select("ref_id", "target_id", *[F.round(c, 6).alias(c) for c in ("overlap", "bearing_diff", "score")])


@query("q270_threshold_decision", q.with_tables("SELECT local_id, decision FROM decided", q.BRIDGE))
def threshold_decision(spark, d):
    return s.bridge(spark, d).select("local_id", matching.decide(F.col("confidence")).alias("decision"))


@query("q271_greedy_assignment")
def greedy_assignment(spark, d):
    return matching.greedy(matching.scored(R(spark, d), T(spark, d))).select("ref_id", "target_id", "confidence")


@query("q272_match_components")
def match_components(spark, d):
    return matching.match_components(matching.scored(R(spark, d), T(spark, d))).select("component", "ref_id", "target_id", "confidence", "structural")


@query("q275_classify_groups")
def classify_groups(spark, d):
    return matching.groups(matching.match_components(matching.scored(R(spark, d), T(spark, d))))


@query("q282_confidence_prune")
def confidence_prune(spark, d):
    return matching.prune(matching.match_components(matching.scored(R(spark, d), T(spark, d)))).select("component", "ref_id", "target_id", "confidence", "decision")


@query("q284_score_propagation")
def score_propagation(spark, d):
    return matching.propagate(matching.scored(R(spark, d), T(spark, d))).withColumn("propagated", F.round("propagated", 6))


@query("q030_bridge_sink")
def bridge_sink(spark, d):
    return matching.bridge(matching.scored(R(spark, d), T(spark, d))).filter("match_decision <> 'no_match'")


@query("q220_sliver_classifier", q.with_tables("SELECT local_id, (end_frac - start_frac) * confidence < 0.10 AND (end_frac - start_frac) * confidence * 40 < 5 AS sliver FROM bridge", q.BRIDGE))
def sliver_classifier(spark, d):
    span = (F.col("end_frac") - F.col("start_frac")) * F.col("confidence")
    return s.bridge(spark, d).select("local_id", matching.is_sliver(span, F.lit(0.0), span * 40, F.lit(0.0)).alias("sliver"))
