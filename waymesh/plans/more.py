"""Further queries: wider features, grouping, assignment rules, models and provenance."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import ranges
from ..functions import text as tx
from ..operators import assignment, blocking, bridges, graph, integration, learned, matching
from ..sources import synthetic as s
from . import sqltext as q
from .registry import query

R, T = s.reference, s.target


def A():
    return F.col("ref_xy")


def B():
    return F.col("target_xy")

W = lambda body, *more: q.with_tables(body, q.BRIDGE, *more)


def both(spark, d, pad):
    return blocking.box_join(R(spark, d), T(spark, d), pad)


@query("q012_convenience_columns", q.with_tables(f"SELECT id, upper(class) AS class_code, level <> 0 AS raised, round({q.bbox('xy', 'max', 'x')} - {q.bbox('xy', 'min', 'x')}, 6) AS width FROM ref"))
def convenience_columns(spark, d):
    b = g.bbox(F.col("xy"))
    return R(spark, d).select("id", F.upper("class").alias("class_code"), (F.col("level") != 0).alias("raised"), F.round(b["xmax"] - b["xmin"], 6).alias("width"))


@query("q021_tag_transform", "SELECT p_partkey, CASE WHEN p_type LIKE '%STEEL%' OR p_type LIKE '%steel%' THEN 'metal' WHEN p_size > 25 THEN 'large' ELSE 'plain' END AS class, p_size % 3 - 1 AS level FROM part")
def tag_transform(spark, d):
    t = F.col("p_type")
    return s.table(spark, d, "part").select("p_partkey", F.when(t.contains("STEEL") | t.contains("steel"), "metal").when(F.col("p_size") > 25, "large").otherwise("plain").alias("class"), (F.col("p_size") % 3 - 1).alias("level"))


@query("q023_connector_fractions", "SELECT way, node, round(sum(step) OVER (PARTITION BY way ORDER BY n, node) / sum(step) OVER (PARTITION BY way), 6) AS at FROM (SELECT l_orderkey AS way, l_partkey AS node, l_linenumber AS n, l_quantity AS step FROM lineitem)")
def connector_fractions(spark, d):
    w = Window.partitionBy("way").orderBy("n", "node")
    x = s.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("way"), F.col("l_partkey").alias("node"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("step"))
    return x.select("way", "node", F.round(F.sum("step").over(w) / F.sum("step").over(Window.partitionBy("way")), 6).alias("at"))


@query("q026_polygon_context", "SELECT s_suppkey FROM supplier WHERE (10 + s_suppkey % 20) * (10 + s_suppkey % 7) >= 200")
def polygon_context(spark, d):
    k = F.col("s_suppkey")
    ring = F.array(g.point(0.0, 0.0), g.point(10 + k % 20, 0.0), g.point(10 + k % 20, 10 + k % 7), g.point(0.0, 10 + k % 7))
    return s.table(spark, d, "supplier").withColumn("ring", ring).filter(g.shoelace(F.col("ring")) >= 200).select("s_suppkey")


@query("q034_groups_sidecar", W("SELECT k % 20 AS group_id, count(*) AS n_edges, count(*) FILTER (decision = 'no_match') AS rejected FROM decided GROUP BY 1"))
def groups_sidecar(spark, d):
    doc = s.bridge(spark, d).groupBy((F.col("k") % 20).alias("group_id")).agg(F.collect_list(F.struct("gers_id", "local_id", "confidence", "decision")).alias("edges"))
    return doc.select("group_id", F.size("edges").cast("long").alias("n_edges"), F.size(F.filter("edges", lambda e: e["decision"] == "no_match")).cast("long").alias("rejected"))


@query("q036_candidates_sidecar", W("SELECT k % 20 AS group_id, gers_id, local_id, confidence FROM bridge"))
def candidates_sidecar(spark, d):
    return s.bridge(spark, d).select((F.col("k") % 20).alias("group_id"), "gers_id", "local_id", "confidence").repartition("group_id").sortWithinPartitions("group_id", "gers_id", "local_id")


@query("q057_class_filter", q.with_tables("SELECT id FROM ref WHERE class NOT IN ('motorway', 'cycleway')"))
def class_filter(spark, d):
    return R(spark, d).filter(~F.col("class").isin("motorway", "cycleway")).select("id")


@query("q064_name_filter")
def name_filter(spark, d):
    n = bridges.with_sides(s.bridge(spark, d), R(spark, d), T(spark, d))
    unnamed = (tx.present(F.col("ref_name")) == 0) | (tx.present(F.col("target_name")) == 0)
    n = n.withColumn("sim", F.when(~unnamed, tx.token_sort_ratio(tx.normalise(F.col("ref_name")), tx.normalise(F.col("target_name")))))
    return n.filter(F.col("sim").isNull() | (F.col("sim") >= 0.5)).select("local_id", "gers_id")


@query("q086_discovery", W("SELECT r.class AS ref_class, t.class AS target_class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY r.class), 6) AS share FROM bridge b JOIN ref r ON r.id = b.gers_id JOIN tgt t ON t.id = b.local_id GROUP BY 1, 2"))
def discovery(spark, d):
    n = bridges.with_sides(s.bridge(spark, d), R(spark, d), T(spark, d)).groupBy("ref_class", "target_class").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("ref_class")), 6))


@query("q091_interval_join", W("SELECT a.local_id, b.local_id AS other_id FROM bridge a JOIN bridge b ON a.gers_id = b.gers_id AND a.local_id < b.local_id AND a.start_frac <= b.end_frac AND b.start_frac <= a.end_frac"))
def interval_join(spark, d):
    b = s.bridge(spark, d).select("gers_id", "local_id", "start_frac", "end_frac")
    o = b.toDF("gers_id", "other_id", "s", "e")
    return b.join(o, "gers_id").filter("local_id < other_id AND start_frac <= e AND s <= end_frac").select("local_id", "other_id")


@query("q111_dataset_counts", W("SELECT 'd' || (k % 3) AS dataset, count(*) AS n FROM decided WHERE decision = 'match' GROUP BY 1"))
def dataset_counts(spark, d):
    return s.bridge(spark, d).filter("decision = 'match'").groupBy(F.concat(F.lit("d"), F.col("k") % 3).alias("dataset")).agg(F.count("*").alias("n"))


@query("q113_prf_targets", W("SELECT count(*) FILTER (said AND good) AS tp, count(*) FILTER (NOT said AND good) AS fn FROM (SELECT t.local_id, bool_or(t.label = 'match') AS good, bool_or(d.decision = 'match') AS said FROM truth t JOIN decided d USING (local_id) GROUP BY 1)"))
def prf_targets(spark, d):
    x = s.truth(spark, d).join(s.bridge(spark, d).select("local_id", "decision"), "local_id").groupBy("local_id").agg(F.bool_or(F.col("label") == "match").alias("good"), F.bool_or(F.col("decision") == "match").alias("said"))
    return x.agg(F.count_if(F.col("said") & F.col("good")).alias("tp"), F.count_if(~F.col("said") & F.col("good")).alias("fn"))


@query("q167_collinear_gap", q.with_tables(f"SELECT ref_id, target_id, CASE WHEN hd <= 15 THEN round(greatest(0.0, least(a1, b1) - greatest(a0, b0)) / least(a1 - a0, b1 - b0), 6) ELSE 1.0 END AS ratio FROM (SELECT *, 0.0 AS a0, n AS a1, least(p, r) AS b0, greatest(p, r) AS b1 FROM (SELECT ref_id, target_id, {q.heading_delta('a', 'b')} AS hd, n, ((b[1].x - a[1].x) * ux + (b[1].y - a[1].y) * uy) / n AS p, ((b[-1].x - a[1].x) * ux + (b[-1].y - a[1].y) * uy) / n AS r FROM (SELECT *, a[-1].x - a[1].x AS ux, a[-1].y - a[1].y AS uy, {q.dist('a[1].x', 'a[1].y', 'a[-1].x', 'a[-1].y')} AS n FROM pairs))) WHERE b1 > b0", q.pairs(10)))
def collinear_gap(spark, d):
    o, e = g.first(A()), g.last(A())
    n = g.distance(o, e)
    on = lambda p: ((p["x"] - o["x"]) * (e["x"] - o["x"]) + (p["y"] - o["y"]) * (e["y"] - o["y"])) / n
    p = both(spark, d, 10.0).withColumns({"n": n, "p": on(g.first(B())), "r": on(g.last(B())), "hd": g.heading_delta(g.heading(A()), g.heading(B()))})
    p = p.withColumns({"lo": F.least("p", "r"), "hi": F.greatest("p", "r")}).filter("hi > lo")
    ratio = F.greatest(F.lit(0.0), F.least("n", "hi") - F.greatest(F.lit(0.0), F.col("lo"))) / F.least(F.col("n"), F.col("hi") - F.col("lo"))
    return p.select("ref_id", "target_id", F.when(F.col("hd") <= 15, F.round(ratio, 6)).otherwise(1.0).alias("ratio"))


@query("q175_parallel_alignment")
def parallel_alignment(spark, d):
    steps = g.let(g.spread(B(), 16), lambda pts: F.zip_with(F.slice(pts, 1, 15), F.slice(pts, 2, 15), g.bearing))
    cos = g.let(g.heading(A()), lambda way: F.transform(steps, lambda h: F.cos(F.radians(g.heading_delta(h, way)))))
    p = both(spark, d, 10.0).withColumn("c", cos)
    return p.select("ref_id", "target_id", F.round(g.mean(F.col("c")), 6).alias("alignment"), F.round(F.size(F.filter("c", lambda v: v >= 0.7)) / F.size("c"), 6).alias("fraction"))


@query("q163_buffer_iou")
def buffer_iou(spark, d):
    return assignment.buffer_iou(both(spark, d, 10.0), 5.0).select("ref_id", "target_id", F.round("iou", 4).alias("iou"))


@query("q193_physical_agreement", W("SELECT local_id, CASE WHEN r.level = b.k % 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS level_match FROM bridge b JOIN ref r ON r.id = b.gers_id"))
def physical_agreement(spark, d):
    j = s.bridge(spark, d).join(R(spark, d).select(F.col("id").alias("gers_id"), "level"), "gers_id")
    return j.select("local_id", F.when(F.col("level") == F.col("k") % 2, 1.0).otherwise(0.0).alias("level_match"))


@query("q195_neighbour_agreement", W("SELECT gers_id, round(greatest(-0.2, least(0.2, sum((confidence - 0.5) * (end_frac - start_frac)))), 6) AS shift FROM bridge GROUP BY 1"))
def neighbour_agreement(spark, d):
    v = F.sum((F.col("confidence") - 0.5) * (F.col("end_frac") - F.col("start_frac")))
    return s.bridge(spark, d).groupBy("gers_id").agg(F.round(F.greatest(F.lit(-0.2), F.least(F.lit(0.2), v)), 6).alias("shift"))


@query("q212_display_name", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS display FROM customer")
def display_name(spark, d):
    en = F.when(F.col("c_custkey") % 2 == 0, F.map_from_arrays(F.array(F.lit("en")), F.array("c_mktsegment")))
    return s.table(spark, d, "customer").select("c_custkey", F.coalesce(en["en"], F.col("c_name")).alias("display"))


@query("q214_undirected_bearing", q.with_tables(f"SELECT id, round(({q.heading('xy')}) % 180, 6) AS bearing FROM ref"))
def undirected_bearing(spark, d):
    return R(spark, d).select("id", F.round(F.pmod(g.heading(F.col("xy")), F.lit(180.0)), 6).alias("bearing"))


@query("q232_endpoint_clusters")
def endpoint_clusters(spark, d):
    return graph.endpoint_clusters(R(spark, d), 12.0).select("id", "which", "cluster")


@query("q249_node_centroids")
def node_centroids(spark, d):
    c = graph.endpoint_clusters(R(spark, d), 12.0)
    return c.groupBy("cluster").agg(F.round(F.avg("p.x"), 6).alias("x"), F.round(F.avg("p.y"), 6).alias("y"), F.count("*").alias("n"))


@query("q263_partial_slicing", W(f"SELECT local_id, round({q.length('t.xy')} * (end_frac - start_frac), 6) AS part_m FROM bridge b JOIN tgt t ON t.id = b.local_id WHERE (start_frac > 0.01 OR end_frac < 0.99) AND len(t.xy) = 2"))
def partial_slicing(spark, d):
    t = T(spark, d).select(F.col("id").alias("local_id"), "xy")
    j = s.bridge(spark, d).filter("start_frac > 0.01 OR end_frac < 0.99").join(t, "local_id").filter(F.size("xy") == 2)
    return j.select("local_id", F.round(g.length(g.sub_line(F.col("xy"), F.col("start_frac"), F.col("end_frac"))), 6).alias("part_m"))


@query("q273_contiguity_groups")
def contiguity_groups(spark, d):
    return assignment.contiguity_groups(T(spark, d), 5.0, 40.0).select("id", "contiguity")


@query("q276_group_tagging", W("SELECT local_id, CASE WHEN avg(confidence) OVER (PARTITION BY k % 30) >= 0.5 THEN 'match' ELSE 'review' END AS tag FROM bridge"))
def group_tagging(spark, d):
    m = F.avg("confidence").over(Window.partitionBy(F.col("k") % 30))
    return s.bridge(spark, d).select("local_id", F.when(m >= 0.5, "match").otherwise("review").alias("tag"))


@query("q277_contested_spans", W("SELECT local_id FROM (SELECT *, max(confidence) OVER (PARTITION BY gers_id) AS best, (end_frac - start_frac) * confidence AS span FROM bridge) WHERE span < 0.3 AND confidence < best"))
def contested_spans(spark, d):
    best = F.max("confidence").over(Window.partitionBy("gers_id"))
    return s.bridge(spark, d).withColumns({"best": best, "span": (F.col("end_frac") - F.col("start_frac")) * F.col("confidence")}).filter("span < 0.3 AND confidence < best").select("local_id")


@query("q278_weak_edge_recovery", W("SELECT local_id, gers_id FROM bridge b WHERE confidence >= 0.1 AND confidence < 0.5 AND gers_id NOT IN (SELECT gers_id FROM bridge WHERE confidence >= 0.5)"))
def weak_edge_recovery(spark, d):
    b = s.bridge(spark, d)
    return b.filter("confidence >= 0.1 AND confidence < 0.5").join(b.filter("confidence >= 0.5").select("gers_id"), "gers_id", "left_anti").select("local_id", "gers_id")


@query("q280_forced_review", W("SELECT local_id, CASE WHEN n = 1 AND confidence < 0.75 AND decision = 'match' THEN 'review' ELSE decision END AS decision FROM (SELECT *, count(*) OVER (PARTITION BY gers_id) AS n FROM decided)"))
def forced_review(spark, d):
    n = F.count("*").over(Window.partitionBy("gers_id"))
    x = s.bridge(spark, d).withColumn("n", n)
    return x.select("local_id", F.when((F.col("n") == 1) & (F.col("confidence") < 0.75) & (F.col("decision") == "match"), "review").otherwise(F.col("decision")).alias("decision"))


@query("q281_coverage_conflicts")
def coverage_conflicts(spark, d):
    return assignment.coverage_conflicts(matching.scored(R(spark, d), T(spark, d)).filter("confidence >= 0.5")).select("ref_id", "target_id", "decision")


@query("q283_group_structure", W("SELECT k % 30 AS g, count(DISTINCT gers_id) AS refs, count(DISTINCT local_id) AS targets, count(*) AS edges, count(*) > 10 AS over_budget FROM bridge GROUP BY 1"))
def group_structure(spark, d):
    return s.bridge(spark, d).groupBy((F.col("k") % 30).alias("g")).agg(F.count_distinct("gers_id").alias("refs"), F.count_distinct("local_id").alias("targets"), F.count("*").alias("edges"), (F.count("*") > 10).alias("over_budget"))


@query("q287_queue_parity", W("SELECT k % 30 AS g, coalesce(list_sort(list(DISTINCT local_id) FILTER (confidence > 0.3)), []) = coalesce(list_sort(list(DISTINCT local_id) FILTER (confidence > 0.32)), []) AS same FROM bridge GROUP BY 1"))
def queue_parity(spark, d):
    pick = lambda c: F.array_sort(F.collect_set(F.when(F.col("confidence") > c, F.col("local_id"))))
    return s.bridge(spark, d).groupBy((F.col("k") % 30).alias("g")).agg((pick(0.3) == pick(0.32)).alias("same"))


FEATURES = ["distance", "heading_diff", "coverage", "overlap_m"]


def labelled(spark, d):
    p = matching.scored(R(spark, d), T(spark, d))
    return p.withColumn("y", (F.regexp_extract("target_id", r"(\d+)", 1) == F.substring("ref_id", 2, 20)).cast("double")).select("ref_id", "target_id", "y", *FEATURES)


@query("q290_scorer_training")
def scorer_training(spark, d):
    rows = matching.scratch(labelled(spark, d))
    model = learned.train(rows, FEATURES, trees=5, depth=3)
    return learned.predict(model, rows, FEATURES).select("ref_id", "target_id", "y", F.round("p", 6).alias("p"))


@query("q292_isotonic_fit")
def isotonic_fit(spark, d):
    p = s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"]).select(F.col("confidence").alias("p"), (F.col("label") == "match").cast("double").alias("y"))
    return spark.createDataFrame(learned.fit_isotonic(p), "x double, y double")


@query("q293_leakage_safe_folds")
def leakage_safe_folds(spark, d):
    return learned.grouped_folds(labelled(spark, d).select("ref_id", "target_id", "y"), "ref_id", "target_id")


@query("q295_plausibility_filter", q.with_tables(f"SELECT ref_id, target_id FROM pairs WHERE list_max({q.vertex_distances('a', 'b')}) <= 60", q.pairs(10)))
def plausibility_filter(spark, d):
    return both(spark, d, 10.0).filter(g.hausdorff(A(), B()) <= 60).select("ref_id", "target_id")


@query("q302_class_predictor")
def class_predictor(spark, d):
    rows = R(spark, d).select("id", "class", g.length(F.col("xy")).alias("n"), F.col("level").cast("double").alias("level"), (F.col("k") % 8).cast("double").alias("residue"))
    return learned.class_predictor(rows, ["n", "level", "residue"], "class").transform(rows).select("id", "class", "prediction")


@query("q305_labels_with_features", W("SELECT t.local_id, t.label, round(d.end_frac - d.start_frac, 6) AS span FROM truth t JOIN decided d USING (gers_id, local_id)"))
def labels_with_features(spark, d):
    return s.truth(spark, d).join(s.bridge(spark, d), ["gers_id", "local_id"]).select("local_id", "label", F.round(F.col("end_frac") - F.col("start_frac"), 6).alias("span"))


@query("q262_priority_overlay")
def priority_overlay(spark, d):
    return integration.net_new(T(spark, d), R(spark, d).filter("k % 2 = 0"), 10.0).filter("net_m > 0.2 * length_m").select("id")


@query("q303_model_contract", "SELECT 4 AS n_features, sha256('distance,heading_diff,coverage,overlap_m') AS contract")
def model_contract(spark, d):
    return spark.range(1).select(F.lit(len(FEATURES)).alias("n_features"), F.sha2(F.lit(",".join(FEATURES)), 256).alias("contract"))


@query("q317_label_fragments", W("SELECT lab, frag, n FROM (SELECT b.k % 25 AS lab, b.k % 35 AS frag, count(*) AS n FROM bridge b JOIN truth t USING (local_id) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY lab ORDER BY n DESC, frag) = 1"))
def label_fragments(spark, d):
    n = s.bridge(spark, d).join(s.truth(spark, d).select("local_id"), "local_id").groupBy((F.col("k") % 25).alias("lab"), (F.col("k") % 35).alias("frag")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("lab").orderBy(F.desc("n"), "frag")
    return n.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


@query("q301_frozen_partitions", W("SELECT gers_id, count(*) AS n FROM bridge WHERE gers_id NOT IN (SELECT gers_id FROM truth WHERE label = 'unsure') GROUP BY 1"))
def frozen_partitions(spark, d):
    out = s.truth(spark, d).filter("label = 'unsure'").select("gers_id")
    return s.bridge(spark, d).join(out, "gers_id", "left_anti").groupBy("gers_id").agg(F.count("*").alias("n"))


@query("q194_coincident_cover")
def coincident_cover(spark, d):
    t = T(spark, d).select("id", "xy")
    p = blocking.box_join(t, t, 5.0).filter("ref_id <> target_id")
    near = p.select(F.col("ref_id").alias("id"), F.explode(g.within_spans(A(), B(), 5.0)).alias("z")).select("id", "z.start", "z.end")
    return ranges.covered(ranges.merge(near, "id", tolerance=0.0), "id").withColumn("covered", F.round("covered", 6))
