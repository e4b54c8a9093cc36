"""Topology, integration and screening queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import blocking, graph, integration, matching
from ..sources import synthetic as s
from . import sqltext as q
from .registry import query

R, T = s.reference, s.target
W = lambda body, *more: q.with_tables(body, q.BRIDGE, *more)

#: An undirected graph over all customers, in blocks of 200 keys: a chain, a hub that every tenth key is linked with, halves, and a leaf at every seventh key.
EDGES = """e0 AS (SELECT c_custkey AS k, c_custkey // 200 * 200 AS b FROM customer),
links AS (SELECT k AS u, greatest(k - 1, b) AS v FROM e0 UNION ALL SELECT k, CASE WHEN k % 10 = 0 THEN b ELSE k END FROM e0 UNION ALL SELECT k, b + (k - b) // 2 FROM e0 UNION ALL SELECT k, CASE WHEN k % 7 = 3 THEN -k ELSE k END FROM e0),
edges AS (SELECT DISTINCT least('n' || u, 'n' || v) AS u, greatest('n' || u, 'n' || v) AS v FROM links WHERE u <> v), b2 AS (SELECT u, v FROM edges UNION ALL SELECT v, u FROM edges)"""
G = lambda body: "WITH " + EDGES + " " + body
GR = lambda body: "WITH RECURSIVE " + EDGES + ", " + body


def edges(spark, d):
    k = F.col("c_custkey")
    block = F.floor(k / 200) * 200
    ends = F.array(F.greatest(k - 1, block), F.when(k % 10 == 0, block).otherwise(k), block + F.floor((k - block) / 2), F.when(k % 7 == 3, -k).otherwise(k))
    return graph.undirected(s.table(spark, d, "customer").select(F.concat(F.lit("n"), k).alias("u"), F.explode(ends).alias("to")).select("u", F.concat(F.lit("n"), "to").alias("v")))


@query("q237_degrees", G("SELECT u AS node, count(*) AS degree FROM b2 GROUP BY u"))
def degrees(spark, d):
    return graph.degrees(edges(spark, d))


@query("q238_connected_components", GR("reach AS (SELECT u AS node, u AS other FROM b2 UNION SELECT r.node, b.v FROM reach r JOIN b2 b ON b.u = r.other) SELECT node, min(other) AS component FROM reach GROUP BY node"))
def connected_components(spark, d):
    return matching.components(edges(spark, d))


@query("q239_k_hop", G("SELECT 'n1' AS start, 'n1' AS node, 0 AS hop UNION ALL SELECT 'n1', v, 1 FROM b2 WHERE u = 'n1' UNION ALL SELECT DISTINCT 'n1', y.v, 2 FROM b2 x JOIN b2 y ON x.v = y.u WHERE x.u = 'n1' AND y.v <> 'n1' AND y.v NOT IN (SELECT v FROM b2 WHERE u = 'n1')"))
def k_hop(spark, d):
    return graph.within_hops(edges(spark, d), spark.createDataFrame([("n1",)], "node string"), 2)


@query("q240_triangles", G("SELECT node, count(*) AS triangles FROM (SELECT unnest([a.u, a.v, b.v]) AS node FROM edges a JOIN edges b ON a.v = b.u JOIN edges c ON c.u = a.u AND c.v = b.v) GROUP BY node"))
def triangles(spark, d):
    return graph.triangles(edges(spark, d))


@query("q191_clustering_coefficient", G("SELECT g.node, degree, coalesce(t, 0) AS triangles, round(CASE WHEN degree > 1 THEN coalesce(t, 0) / (degree * (degree - 1) / 2) ELSE 0 END, 6) AS coefficient FROM (SELECT u AS node, count(*) AS degree FROM b2 GROUP BY u) g LEFT JOIN (SELECT node, count(*) AS t FROM (SELECT unnest([a.u, a.v, b.v]) AS node FROM edges a JOIN edges b ON a.v = b.u JOIN edges c ON c.u = a.u AND c.v = b.v) GROUP BY node) USING (node)"))
def clustering_coefficient(spark, d):
    return graph.clustering(edges(spark, d)).withColumn("coefficient", F.round("coefficient", 6))


@query("q241_two_hop_and_squares", G("SELECT node, two_hop, squares FROM (SELECT x.u AS node, count(DISTINCT y.v) AS two_hop FROM b2 x JOIN b2 y ON x.v = y.u WHERE x.u <> y.v AND NOT EXISTS (SELECT 1 FROM b2 z WHERE z.u = x.u AND z.v = y.v) GROUP BY 1) JOIN (SELECT u AS node, sum(n * (n - 1) // 2)::BIGINT AS squares FROM (SELECT x.u, y.u AS w, count(*) AS n FROM b2 x JOIN b2 y ON x.v = y.v WHERE x.u <> y.u GROUP BY 1, 2) GROUP BY 1) USING (node)"))
def two_hop_and_squares(spark, d):
    e = edges(spark, d)
    return graph.two_hop(e).join(graph.squares(e), "node")


@query("q242_articulation_and_bridges")
def articulation_and_bridges(spark, d):
    return graph.cut_points_and_bridges(edges(spark, d))


@query("q233_topology_by_clusters")
def topology_by_clusters(spark, d):
    return graph.topology(graph.endpoint_clusters(R(spark, d), 15.0))


CONN = "conn AS (SELECT c_custkey AS seg, unnest([c_custkey % 200, c_custkey * 3 % 200]) AS connector FROM customer)"


@query("q234_topology_by_connectors", f"WITH {CONN} SELECT connector, count(DISTINCT seg) AS degree FROM conn GROUP BY 1")
def topology_by_connectors(spark, d):
    k = F.col("c_custkey")
    return s.table(spark, d, "customer").select(k.alias("seg"), F.explode(F.array(k % 200, k * 3 % 200)).alias("connector")).groupBy("connector").agg(F.count_distinct("seg").alias("degree"))


@query("q094_connector_degree", f"WITH {CONN}, deg AS (SELECT connector, count(DISTINCT seg) AS degree FROM conn GROUP BY 1) SELECT seg, max(degree) AS top_degree, max(degree) >= 3 AS intersection FROM conn JOIN deg USING (connector) GROUP BY seg")
def connector_degree(spark, d):
    k = F.col("c_custkey")
    c = s.table(spark, d, "customer").select(k.alias("seg"), F.explode(F.array(k % 200, k * 3 % 200)).alias("connector"))
    deg = c.groupBy("connector").agg(F.count_distinct("seg").alias("degree"))
    return c.join(deg, "connector").groupBy("seg").agg(F.max("degree").alias("top_degree"), (F.max("degree") >= 3).alias("intersection"))


@query("q022_junction_nodes", "SELECT l_partkey AS node, count(DISTINCT l_orderkey) AS ways FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 2")
def junction_nodes(spark, d):
    ways = s.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("way")).agg(F.collect_list("l_partkey").alias("nodes"))
    return ways.select("way", F.explode("nodes").alias("node")).groupBy("node").agg(F.count_distinct("way").alias("ways")).filter("ways >= 2")


@query("q236_connector_graph", "SELECT l_orderkey AS way, l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS b FROM lineitem QUALIFY lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) IS NOT NULL")
def connector_graph(spark, d):
    ways = s.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("way")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("n"))
    m = F.size("n") - 1
    pairs = F.zip_with(F.slice("n", 1, m), F.slice("n", 2, m), lambda a, b: F.struct(a["l_partkey"].alias("a"), b["l_partkey"].alias("b")))
    return ways.select("way", F.inline(pairs))


@query("q100_dead_ends", q.with_tables(f"SELECT id, which FROM ends a WHERE NOT EXISTS (SELECT 1 FROM ends b WHERE a.id <> b.id AND abs(a.x - b.x) <= 12 AND {q.dist('a.x', 'a.y', 'b.x', 'b.y')} <= 12)", "ends AS (SELECT id, 0 AS which, xy[1].x AS x, xy[1].y AS y FROM ref UNION ALL SELECT id, 1, xy[-1].x, xy[-1].y FROM ref)"))
def dead_ends(spark, d):
    e = blocking.endpoints(R(spark, d))
    near = blocking.point_join(e, e, 12.0).filter("id <> r_id").select("id", "which").distinct()
    return e.join(near, ["id", "which"], "left_anti").select("id", "which")


@query("q251_network_validation", G("SELECT count(*) AS nodes, count(*) FILTER (degree = 1) AS dead_ends, count(*) FILTER (degree >= 3) AS junctions, sum(degree)::BIGINT AS half_edges FROM (SELECT u, count(*) AS degree FROM b2 GROUP BY u)"))
def network_validation(spark, d):
    return graph.degrees(edges(spark, d)).agg(F.count("*").alias("nodes"), F.count_if(F.col("degree") == 1).alias("dead_ends"), F.count_if(F.col("degree") >= 3).alias("junctions"), F.sum("degree").alias("half_edges"))


@query("q252_islands")
def islands(spark, d):
    return integration.islands(R(spark, d), 12.0)


@query("q253_endpoint_snapping")
def endpoint_snapping(spark, d):
    return integration.snapped(R(spark, d), 6.0).select("id", F.round(g.length(F.col("xy")), 6).alias("length_m"))


@query("q254_gps_drift")
def gps_drift(spark, d):
    return integration.drift(R(spark, d))


@query("q247_planarise")
def planarise(spark, d):
    return integration.planarised(R(spark, d)).select("id", "parent", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), F.round(g.length(F.col("xy")), 6).alias("length_m"))


@query("q255_screen_report")
def screen_report(spark, d):
    t, r = T(spark, d), R(spark, d)
    rings = s.table(spark, d, "supplier").select(F.concat(F.lit("p"), "s_suppkey").alias("id"), F.array(*[g.point(F.col("s_suppkey") * 7919 % 2000 + x, F.col("s_suppkey") * 104729 % 2000 + y) for x, y in ((0, 0), (30, 0), (30, 30), (0, 30))]).alias("xy"))
    return integration.report({"length": integration.length_screen(t), "polygon_buffer": integration.polygon_buffer(t, rings), "fringe": integration.fringe(t, r)})


@query("q258_net_new")
def net_new(spark, d):
    out = integration.net_new(T(spark, d), R(spark, d).filter("k % 2 = 0"), 15.0)
    return out.select("id", *[F.round(c, 3).alias(c) for c in ("length_m", "covered_m", "net_m")])


REM = f"SELECT b.local_id || '_remnant_1' AS id, b.local_id AS parent, round(CASE WHEN start_frac > 0 THEN 0.0 ELSE end_frac END, 6)::DOUBLE AS start, round(CASE WHEN start_frac > 0 THEN start_frac ELSE 1.0 END, 6)::DOUBLE AS \"end\" FROM decided b JOIN tgt t ON t.id = b.local_id WHERE decision = 'match' AND (start_frac > 0 OR end_frac < 1) AND 0.5 * {q.length('t.xy')} >= 3"


@query("q261_unmatched_remnants", W(REM))
def unmatched_remnants(spark, d):
    return integration.remnants(T(spark, d), s.bridge(spark, d)).select("id", "parent", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("q264_orphans")
def orphans(spark, d):
    return integration.orphans(T(spark, d), R(spark, d).filter("k % 2 = 0"))


@query("q268_integration")
def integrated(spark, d):
    return integration.integrate(R(spark, d), T(spark, d), s.bridge(spark, d)).select("id", "source")


@query("q059_connector_restrict", f"WITH {CONN} SELECT DISTINCT connector FROM conn WHERE seg IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0)")
def connector_restrict(spark, d):
    k = F.col("c_custkey")
    c = s.table(spark, d, "customer").select(k.alias("seg"), F.explode(F.array(k % 200, k * 3 % 200)).alias("connector"))
    return c.join(s.table(spark, d, "customer").filter(k % 5 == 0).select(k.alias("seg")), "seg", "left_semi").select("connector").distinct()


@query("q186_signature_similarity", "SELECT c_custkey, round(1 - (abs(c_custkey % 5 - c_custkey % 3) + abs(c_custkey % 4 - c_custkey % 2)) / greatest(1.0, c_custkey % 5 + c_custkey % 3 + c_custkey % 4 + c_custkey % 2), 6) AS match FROM customer")
def signature_similarity(spark, d):
    k = F.col("c_custkey")
    return s.table(spark, d, "customer").select("c_custkey", F.round(1 - (F.abs(k % 5 - k % 3) + F.abs(k % 4 - k % 2)) / F.greatest(F.lit(1.0), k % 5 + k % 3 + k % 4 + k % 2), 6).alias("match"))
