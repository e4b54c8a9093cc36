"""Alignment, name and class rules, connector features, blocks of graphs, verdicts and stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text as tx
from ..operators import alignment, assignment, blocking, bridges, graph, labels, matching, verdicts
from ..sources import files
from ..sources import synthetic as s
from . import sqltext as q
from .graphs import G, edges
from .registry import query
from .scalars import RANK

R, T = s.reference, s.target
W = lambda body, *more: q.with_tables(body, q.BRIDGE, *more)
SIDES = "n AS (SELECT b.local_id, r.name AS ref_name, t.name AS target_name, r.class AS ref_class, t.class AS target_class FROM bridge b JOIN ref r ON r.id = b.gers_id JOIN tgt t ON t.id = b.local_id)"


def sides(spark, d):
    return bridges.with_sides(s.bridge(spark, d), R(spark, d), T(spark, d))


def aligned(spark, d):
    p = blocking.box_join(R(spark, d).select("id", "xy"), T(spark, d).select("id", "xy"), 10.0)
    return alignment.aligned(p, F.col("ref_xy"), F.col("target_xy"))


@query("q151_alignment_search")
def alignment_search(spark, d):
    return aligned(spark, d).select("ref_id", "target_id", *[F.round(c, 6).alias(c) for c in ("ref_start", "ref_end", "target_start", "target_end", "score")], "is_reversed")


@query("q152_alignment_coverage")
def alignment_coverage(spark, d):
    return aligned(spark, d).select("ref_id", "target_id", *[F.round(c, 6).alias(c) for c in ("ref_coverage", "target_coverage", "target_from", "target_to")])


@query("q153_junction_tightening")
def junction_tightening(spark, d):
    return aligned(spark, d).filter("tightened").select("ref_id", "target_id", F.round("ref_coverage", 6).alias("ref_coverage"), F.round("target_coverage", 6).alias("target_coverage"))


@query("q154_divergence_truncation")
def divergence_truncation(spark, d):
    return aligned(spark, d).filter("truncated").select("ref_id", "target_id", F.round("ref_start", 6).alias("ref_start"), F.round("ref_end", 6).alias("ref_end"))


@query("q173_length_bin", q.with_tables(f"SELECT id, CASE WHEN n < 10 THEN 0 WHEN n < 100 THEN 1 WHEN n < 500 THEN 2 ELSE 3 END AS bin FROM (SELECT id, {q.length('xy')} AS n FROM ref)"))
def length_bin(spark, d):
    return R(spark, d).select("id", g.length_bin(g.length(F.col("xy"))).alias("bin"))


def _rank(c: str) -> str:
    return f"coalesce({RANK.format(c)}, 6)"


@query("q182_class_match", W(f"SELECT local_id, coalesce(ref_class, '') = '' OR coalesce(target_class, '') = '' OR ref_class = target_class OR abs({_rank('ref_class')} - {_rank('target_class')}) <= 2 AS compatible FROM n", SIDES))
def class_match(spark, d):
    unknown = (F.coalesce("ref_class", F.lit("")) == "") | (F.coalesce("target_class", F.lit("")) == "")
    step = F.abs(F.expr(_rank("ref_class")) - F.expr(_rank("target_class")))
    return sides(spark, d).select("local_id", (unknown | (F.col("ref_class") == F.col("target_class")) | (step <= 2)).alias("compatible"))


#: Route names of both sides of a customer, as Spark and DuckDB read them.
LEFT = "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN concat('I-', c_custkey % 99) WHEN c_custkey % 3 = 1 THEN concat('US Highway ', c_custkey % 50) ELSE c_mktsegment END"
RIGHT = "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN concat('Interstate ', c_custkey % 33) ELSE c_mktsegment END"
NUMBERS = f"SELECT c_custkey, a, b, nullif(regexp_extract(a, '([0-9]+)$', 1), '')::BIGINT AS x, nullif(regexp_extract(b, '([0-9]+)$', 1), '')::BIGINT AS y FROM (SELECT c_custkey, {LEFT} AS a, {RIGHT} AS b FROM customer)"


def route_names(spark, d):
    return s.table(spark, d, "customer").select("c_custkey", F.expr(LEFT).alias("a"), F.expr(RIGHT).alias("b"))


@query("q209_numeric_route_match", f"SELECT c_custkey, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN CASE WHEN x = y THEN 1.0 ELSE 0.0 END END::DOUBLE AS numeric_match FROM ({NUMBERS})")
def numeric_route_match(spark, d):
    return route_names(spark, d).select("c_custkey", tx.numeric_match(F.col("a"), F.col("b")).alias("numeric_match"))


@query("q210_route_number", f"SELECT c_custkey, CASE WHEN x IS NOT NULL THEN x::VARCHAR END AS route, CASE WHEN coalesce(a, '') <> '' AND coalesce(b, '') <> '' THEN lower(trim(a)) = lower(trim(b)) OR coalesce(x = y, false) END AS compatible FROM ({NUMBERS})")
def route_number(spark, d):
    return route_names(spark, d).select("c_custkey", tx.route_number(F.col("a")).alias("route"), tx.names_compatible(F.col("a"), F.col("b")).alias("compatible"))


@query("q211_likely_same_road")
def likely_same_road(spark, d):
    return sides(spark, d).select("local_id", tx.likely_same(F.col("ref_name"), F.col("target_name")).alias("same"))


SPANS = "SELECT local_id, round((end_frac - start_frac) * confidence, 6) AS a, round((end_frac - start_frac) * confidence / 2, 6) AS b, k FROM bridge"


@query("q221_borderline_sliver", W(f"SELECT local_id, CASE WHEN greatest(a, b) < 0.10 AND greatest(a, b) * 40 < 5 THEN 'SLIVER' WHEN greatest(a, b) < 0.15 THEN 'BORDERLINE' END AS tag FROM ({SPANS})"))
def borderline_sliver(spark, d):
    span = F.round((F.col("end_frac") - F.col("start_frac")) * F.col("confidence"), 6)
    x = s.bridge(spark, d).select("local_id", span.alias("a"), F.round(span / 2, 6).alias("b"))
    sliver = matching.is_sliver(F.col("a"), F.col("b"), F.col("a") * 40, F.col("b") * 40)
    return x.select("local_id", F.when(sliver, "SLIVER").when(F.greatest("a", "b") < 0.15, "BORDERLINE").alias("tag"))


LEVEL = "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '2' ELSE '-1' END"


@query("q061_level_rules", f"SELECT c_custkey, CASE WHEN try_cast({LEVEL} AS INT) IS NULL THEN 0 ELSE 1 END AS n_rules FROM customer")
def level_rules(spark, d):
    return _with_level_rules(spark, d).select("c_custkey", F.size("rules").alias("n_rules"))


def _with_level_rules(spark, d):
    # an empty array is an unknown level, which is not ground level
    return s.table(spark, d, "customer").select("c_custkey", F.expr(f"filter(array(named_struct('value', try_cast({LEVEL} AS INT))), r -> r.value IS NOT NULL)").alias("rules"))


@query("q063_level_from_rules", f"SELECT c_custkey, coalesce(try_cast({LEVEL} AS INT), 0) AS level FROM customer")
def level_from_rules(spark, d):
    return _with_level_rules(spark, d).select("c_custkey", F.coalesce(F.get("rules", F.lit(0))["value"], F.lit(0)).alias("level"))


@query("q047_column_resolve", "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def column_resolve(spark, d):
    c = s.table(spark, d, "customer")
    return c.groupBy(F.col(files.resolve_column(c, "C_MktSegment")).alias("segment")).agg(F.count("*").alias("n"))


@query("q083_prediction_audit", W("SELECT t.local_id, t.label, d.decision, d.confidence, r.class AS ref_class, t.label = d.decision AS agrees FROM truth t JOIN decided d USING (gers_id, local_id) JOIN ref r ON r.id = t.gers_id"))
def prediction_audit(spark, d):
    j = s.truth(spark, d).join(s.bridge(spark, d), ["gers_id", "local_id"]).join(R(spark, d).select(F.col("id").alias("gers_id"), F.col("class").alias("ref_class")), "gers_id")
    return j.select("local_id", "label", "decision", "confidence", "ref_class", (F.col("label") == F.col("decision")).alias("agrees"))


SINUOSITY = f"{q.length('xy')} / {q.dist('xy[1].x', 'xy[1].y', 'xy[-1].x', 'xy[-1].y')}"


@query("q099_jaggedness_stats", q.with_tables(f"SELECT class, round(avg(v), 6) AS mean_sinuosity, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.95), 6) AS p95, avg(len(xy) - 2) AS mean_bends FROM (SELECT class, xy, {SINUOSITY} AS v FROM ref) GROUP BY class"))
def jaggedness_stats(spark, d):
    x = R(spark, d).select("class", F.size("xy").alias("n"), g.sinuosity(F.col("xy")).alias("v"))
    return x.groupBy("class").agg(F.round(F.avg("v"), 6).alias("mean_sinuosity"), F.round(F.percentile("v", 0.5), 6).alias("median"), F.round(F.percentile("v", 0.95), 6).alias("p95"), F.avg(F.col("n") - 2).alias("mean_bends"))


@query("q104_quick_fingerprint", q.with_tables("SELECT class, count(*) AS n, count(*) FILTER (trim(coalesce(name, '')) <> '') AS named, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ref GROUP BY class"))
def quick_fingerprint(spark, d):
    by = R(spark, d).groupBy("class").agg(F.count("*").alias("n"), F.sum(tx.present(F.col("name"))).cast("long").alias("named"))
    total = R(spark, d).agg(F.count("*").alias("all"))  # one row, so that no window gathers the table
    return by.crossJoin(F.broadcast(total)).select("class", "n", "named", F.round(F.col("n") / F.col("all"), 6).alias("share"))


def near_copies(spark, d):
    p = blocking.box_join(T(spark, d).select("id", "xy"), R(spark, d).select("id", "xy"), 2.0)
    return assignment.buffer_iou(p, 5.0).filter("iou >= 0.5")


@query("q259_near_duplicates")
def near_duplicates(spark, d):
    best = near_copies(spark, d).groupBy("ref_id").agg(F.max(F.struct(F.round("iou", 4).alias("iou"), "target_id")).alias("m"))
    return best.select(F.col("ref_id").alias("id"), F.col("m.target_id").alias("duplicate_of"), F.col("m.iou").alias("iou"))


@query("q101_near_duplicate_ratio")
def near_duplicate_ratio(spark, d):
    hit = near_copies(spark, d).select(F.col("ref_id").alias("id")).distinct().withColumn("hit", F.lit(1))
    return T(spark, d).select("id").join(hit, "id", "left").agg(F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("ratio"))


@query("q178_walk_distance")
def walk_distance(spark, d):
    a, b = F.col("ref_xy"), F.col("target_xy")
    p = blocking.box_join(R(spark, d).select("id", "xy"), T(spark, d).select("id", "xy"), 10.0).withColumns({"p": g.spread(a, 17), "q": g.spread(b, 17)})
    flip = g.distance(F.element_at("p", 1), F.element_at("q", 1)) > g.distance(F.element_at("p", 1), F.element_at("q", -1))
    p = p.withColumn("q", F.when(flip, F.reverse("q")).otherwise(F.col("q")))
    steps = lambda c: F.zip_with(F.slice(c, 1, 16), F.slice(c, 2, 16), g.bearing)
    cos2 = F.zip_with(steps("p"), steps("q"), lambda x, y: F.pow(F.cos(F.radians(x - y)), 2))
    return p.select("ref_id", "target_id", F.round(g.mean(F.zip_with("p", "q", g.distance)), 6).alias("walk_m"), F.round(g.mean(cos2), 6).alias("parallelness"))


ENDS = "ends AS (SELECT id, 0 AS which, xy[1].x AS x, xy[1].y AS y FROM ref UNION ALL SELECT id, 1, xy[-1].x, xy[-1].y FROM ref)"


@query("q184_endpoint_proximity", q.with_tables(f"SELECT a.id, a.which, round(min(dist), 6) AS nearest_m, count(*) FILTER (dist <= 15) AS within FROM (SELECT a.id, a.which, {q.dist('a.x', 'a.y', 'b.x', 'b.y')} AS dist FROM ends a JOIN ends b ON a.id <> b.id AND abs(a.x - b.x) <= 40 AND abs(a.y - b.y) <= 40) a WHERE dist <= 40 GROUP BY a.id, a.which", ENDS))
def endpoint_proximity(spark, d):
    e = blocking.endpoints(R(spark, d))
    near = blocking.point_join(e, e, 40.0).filter("id <> r_id").withColumn("dist", g.distance(F.col("p"), F.col("r_p")))
    return near.groupBy("id", "which").agg(F.round(F.min("dist"), 6).alias("nearest_m"), F.count_if(F.col("dist") <= 15).alias("within"))


#: A way's connectors: the part keys of an order, in line order.
WAYS = "ways AS (SELECT l_orderkey AS way, list(l_partkey ORDER BY l_linenumber, l_partkey) AS nodes FROM lineitem GROUP BY 1), deg AS (SELECT l_partkey AS node, count(DISTINCT l_orderkey) AS degree FROM lineitem GROUP BY 1)"


def ways(spark, d):
    w = s.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("way")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("n"))
    return w.select("way", F.transform("n", lambda x: x["l_partkey"]).alias("nodes"))


def neighbours(spark, d):
    w = ways(spark, d)
    return w.join(w.select((F.col("way") - 1).alias("way"), F.col("nodes").alias("others")), "way")


@query("q188_interior_junctions", f"WITH {WAYS} SELECT way, len(a) AS n_ref, len(b) AS n_target, abs(len(a) - len(b)) AS gap, round(CASE WHEN len(list_distinct(a || b)) = 0 THEN 0 ELSE len(list_intersect(a, b)) / len(list_distinct(a || b)) END, 6)::DOUBLE AS jaccard FROM (SELECT x.way, list_distinct(x.nodes[2:-2]) AS a, list_distinct(y.nodes[2:-2]) AS b FROM ways x JOIN ways y ON y.way = x.way + 1)")
def interior_junctions(spark, d):
    inner = lambda c: F.array_distinct(F.slice(c, 2, F.greatest(F.size(c) - 2, F.lit(0))))
    x = neighbours(spark, d).select("way", inner("nodes").alias("a"), inner("others").alias("b"))
    both, either = F.size(F.array_intersect("a", "b")), F.size(F.array_union("a", "b"))
    na, nb = F.size("a").cast("long"), F.size("b").cast("long")
    return x.select("way", na.alias("n_ref"), nb.alias("n_target"), F.abs(na - nb).alias("gap"), F.round(F.when(either > 0, both / either).otherwise(0.0), 6).alias("jaccard"))


@query("q189_shared_anchors", f"WITH {WAYS} SELECT x.way, len(list_intersect(list_distinct([x.nodes[1], x.nodes[-1]]), list_distinct(y.nodes))) AS shared FROM ways x JOIN ways y ON y.way = x.way + 1")
def shared_anchors(spark, d):
    ends = F.array_distinct(F.array(F.element_at("nodes", 1), F.element_at("nodes", -1)))
    return neighbours(spark, d).select("way", F.size(F.array_intersect(ends, F.array_distinct("others"))).cast("long").alias("shared"))


STEP = "CASE abs({0} - {1}) WHEN 0 THEN 1.0 WHEN 1 THEN 0.67 WHEN 2 THEN 0.33 ELSE 0.0 END"


@query("q190_endpoint_degree_similarity", f"WITH {WAYS} SELECT way, round(({STEP.format('a.degree', 'c.degree')} + {STEP.format('b.degree', 'e.degree')}) / 2, 6)::DOUBLE AS similarity FROM (SELECT x.way, x.nodes[1] AS n1, x.nodes[-1] AS n2, y.nodes[1] AS m1, y.nodes[-1] AS m2 FROM ways x JOIN ways y ON y.way = x.way + 1) JOIN deg a ON a.node = n1 JOIN deg b ON b.node = n2 JOIN deg c ON c.node = m1 JOIN deg e ON e.node = m2")
def endpoint_degree_similarity(spark, d):
    deg = s.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("node")).agg(F.count_distinct("l_orderkey").alias("degree"))
    w = ways(spark, d).select("way", F.element_at("nodes", 1).alias("n1"), F.element_at("nodes", -1).alias("n2"))
    for c in ("n1", "n2"):  # each way's own end degrees first, so that neighbours need one join
        w = w.join(deg.withColumnsRenamed({"node": c, "degree": f"{c}_degree"}), c)
    w = w.select("way", "n1_degree", "n2_degree")
    j = w.join(w.select((F.col("way") - 1).alias("way"), F.col("n1_degree").alias("m1"), F.col("n2_degree").alias("m2")), "way")
    return j.select("way", F.round((graph.degree_similarity(F.col("n1_degree"), F.col("m1")) + graph.degree_similarity(F.col("n2_degree"), F.col("m2"))) / 2, 6).alias("similarity"))


@query("q246_degree_signatures", G("SELECT x.u AS node, count(*) AS degree, list_sort(list(g.degree)) AS around FROM b2 x JOIN (SELECT u AS node, count(*) AS degree FROM b2 GROUP BY u) g ON g.node = x.v GROUP BY x.u"))
def degree_signatures(spark, d):
    return graph.degree_signatures(edges(spark, d))


@query("q244_biconnected_blocks")
def biconnected_blocks(spark, d):
    return graph.biconnected(edges(spark, d))


def _geo(c: str, i: str) -> tuple[str, str]:
    return f"({c}[{i}].x / 1e5 - 71.0)", f"({c}[{i}].y / 1e5 + 42.0)"


def _lambert(ax: str, ay: str, bx: str, by: str) -> str:
    f = f"{g.FLATTENING!r}"
    beta = lambda y: f"atan((1 - {f}) * tan(radians({y})))"
    p, v = f"(({beta(ay)} + {beta(by)}) / 2)", f"(({beta(by)} - {beta(ay)}) / 2)"
    h = f"(pow(sin({v}), 2) + cos({beta(ay)}) * cos({beta(by)}) * pow(sin(radians({bx} - {ax}) / 2), 2))"
    w = f"(2 * asin(least(1.0, sqrt({h}))))"
    x = f"({w} - sin({w})) * pow(sin({p}) * cos({v}) / cos({w} / 2), 2)"
    y = f"({w} + sin({w})) * pow(cos({p}) * sin({v}) / sin({w} / 2), 2)"
    return f"CASE WHEN {h} = 0 THEN 0.0 ELSE {g.AXIS} * ({w} - {f} / 2 * ({x} + {y})) END"


@query("q229_geodetic_length", q.with_tables(f"SELECT id, round(list_sum(list_transform(range(1, len(xy)), lambda i: {_lambert(*_geo('xy', 'i'), *_geo('xy', 'i+1'))})), 3) AS metres FROM ref"))
def geodetic_length(spark, d):
    degrees = F.transform("xy", lambda p: g.point(p["x"] / 1e5 - 71.0, p["y"] / 1e5 + 42.0))
    return R(spark, d).select("id", F.round(g.geodesic_length(degrees), 3).alias("metres"))


@query("q235_topology_sampling")
def topology_sampling(spark, d):
    r = R(spark, d)
    c = graph.endpoint_clusters(r, 12.0)
    nodes = c.groupBy("cluster").agg(F.count_distinct("id").alias("degree"), F.avg("p.x").alias("x"), F.avg("p.y").alias("y"))
    nodes = nodes.select(F.col("cluster").alias("id"), F.lit(0).alias("which"), g.point(F.col("x"), F.col("y")).alias("p"), "degree")
    pts = r.select("id", F.posexplode(g.samples(F.col("xy"), 20.0)).alias("which", "p"))
    near = blocking.point_join(pts, nodes.select("id", "which", "p"), 15.0).withColumn("far", g.distance(F.col("p"), F.col("r_p")))
    best = near.groupBy("id", "which").agg(F.min(F.struct("far", "r_id")).alias("m")).select("id", "which", F.col("m.r_id").alias("cluster"))
    return best.join(nodes.select(F.col("id").alias("cluster"), "degree"), "cluster").select("id", F.col("which").alias("sample"), "degree")


@query("q245_recompose", W("SELECT gers_id AS parent, CASE WHEN count(*) FILTER (decision = 'review') > 0 THEN 'failed' WHEN count(*) FILTER (decision = 'no_match') > 0 THEN 'unvoted' ELSE 'complete' END AS status, count(*) AS n_subproblems, count(*) FILTER (decision = 'match') AS n_resolved, list_sort(coalesce(list(gers_id || '~' || local_id) FILTER (decision = 'match'), [])) AS union_edges FROM decided GROUP BY 1"))
def recompose(spark, d):
    b = s.bridge(spark, d)
    votes = b.filter("decision <> 'no_match'").select(F.col("local_id").alias("sub"), F.when(F.col("decision") == "match", "auto_accept").otherwise("human_review").alias("routing"), F.array(F.concat_ws("~", "gers_id", "local_id")).alias("edges"))
    return verdicts.recomposed(b.select(F.col("gers_id").alias("parent"), F.col("local_id").alias("sub")), votes)


@query("q294_model_choice", q.with_tables("SELECT class, round(avg(CASE WHEN trim(coalesce(name, '')) <> '' THEN 1.0 ELSE 0.0 END), 6) AS coverage, CASE WHEN avg(CASE WHEN trim(coalesce(name, '')) <> '' THEN 1.0 ELSE 0.0 END) >= 0.75 THEN 'full' ELSE 'geometry' END AS model FROM ref GROUP BY class"))
def model_choice(spark, d):
    return verdicts.chosen_model(R(spark, d), "name", "class", 0.75).withColumn("coverage", F.round("coverage", 6))


@query("q306_feature_upsert", W("SELECT gers_id, local_id, CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END AS version, round(CASE WHEN k % 2 = 0 THEN confidence / 2 ELSE confidence END, 6) AS confidence FROM bridge"))
def feature_upsert(spark, d):
    b = s.bridge(spark, d)
    old = b.select("gers_id", "local_id", F.lit(1).alias("version"), F.round("confidence", 6).alias("confidence"))
    fresh = b.filter("k % 2 = 0").select("gers_id", "local_id", F.lit(2).alias("version"), F.round(F.col("confidence") / 2, 6).alias("confidence"))
    return labels.upsert(old, fresh, "gers_id", "local_id")


ROUTES = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'auto_accept' ELSE 'human_review' END AS routing, CASE event_id % 5 WHEN 0 THEN 'unanimous' WHEN 1 THEN 'quorum' WHEN 2 THEN 'majority' WHEN 3 THEN 'none' ELSE 'other' END AS consensus,
CASE WHEN event_id % 7 < 2 THEN 'NONE' ELSE 'A' END AS choice, CASE WHEN event_id % 11 = 0 THEN 'x=B; y=A' END AS minority, event_id % 5 AS n_valid, event_id % 5 + event_id % 2 AS n_votes, CASE event_id % 13 WHEN 0 THEN 'size_gated' WHEN 1 THEN 'unanimous_NONE' WHEN 2 THEN 'majority' END AS stamped FROM events"""


@query("q312_route_reason", f"""SELECT event_id, CASE WHEN stamped = 'unanimous_NONE' THEN 'unanimous_none' WHEN stamped = 'size_gated' THEN stamped
WHEN routing = 'auto_accept' THEN CASE WHEN consensus = 'quorum' OR n_valid <> n_votes THEN 'quorum' ELSE 'unanimous' END
WHEN consensus IN ('unanimous', 'quorum') THEN CASE WHEN choice = 'NONE' THEN CASE consensus WHEN 'quorum' THEN 'quorum_none' ELSE 'unanimous_none' END ELSE 'class-mismatch' END
WHEN consensus = 'majority' THEN CASE WHEN minority IS NOT NULL THEN 'dissent:x=B,y=A' WHEN n_valid >= 3 THEN 'abstention' ELSE 'below_quorum:' || n_valid END
WHEN consensus = 'none' THEN CASE WHEN n_valid = 0 THEN 'all_abstained' ELSE 'no_majority' END ELSE '' END AS reason FROM ({ROUTES})""")
def route_reason(spark, d):
    s.table(spark, d, "events").createOrReplaceTempView("events")
    c = F.col
    return spark.sql(ROUTES).select("event_id", verdicts.route_reason(c("routing"), c("consensus"), c("choice"), c("minority"), c("n_valid"), c("n_votes"), c("stamped")).alias("reason"))


@query("q313_set_labels", "WITH p AS (SELECT l_orderkey AS g, l_partkey % 3 AS r, l_suppkey % 3 AS t, bool_or(l_quantity > 10) AS lab, bool_or(l_quantity > 40) AS opt FROM lineitem GROUP BY ALL), l AS (SELECT * FROM p WHERE lab), grid AS (SELECT p.* FROM p WHERE EXISTS (SELECT 1 FROM l WHERE l.g = p.g AND l.r = p.r) AND EXISTS (SELECT 1 FROM l WHERE l.g = p.g AND l.t = p.t)) SELECT g AS group_id, list_sort(list(DISTINCT r) FILTER (lab)) AS ref_ids, list_sort(list(DISTINCT t) FILTER (lab)) AS target_ids FROM grid GROUP BY g HAVING bool_and(lab) AND bool_or(lab AND NOT opt) AND count(DISTINCT r) FILTER (lab) > 1 AND count(DISTINCT t) FILTER (lab) > 1")
def set_labels(spark, d):
    p = s.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("group_id"), (F.col("l_partkey") % 3).alias("ref_id"), (F.col("l_suppkey") % 3).alias("target_id"))
    return verdicts.set_labels(p.agg(F.bool_or(F.col("l_quantity") > 10).alias("labelled"), F.bool_or(F.col("l_quantity") > 40).alias("chosen")))


@query("q314_standing_decisions")
def standing_decisions(spark, d):
    return verdicts.standing_decisions(s.table(spark, d, "events"), "user_id", F.col("event_type"), F.col("event_id") % 4 == 0, "ts", "event_id")
