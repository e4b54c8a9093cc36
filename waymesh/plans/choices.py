"""Group alternatives and menus, additions to matches, orphan triage, name bundles, assembly and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import ranges
from ..functions import text as tx
from ..operators import choices, graph, integration, learned, matching
from ..sources import files
from ..sources import synthetic as s
from . import sqltext as q
from .more import FEATURES, labelled
from .registry import query
from .rules import sides

R, T = s.reference, s.target
K = 5

#: Edges of a group, an order: three targets, four references of which neighbours touch, whole quantities as confidence.
EDGES = """e AS (SELECT l_orderkey AS g, l_suppkey % 3 AS t, l_partkey % 4 AS r, max(l_quantity)::DOUBLE AS c FROM lineitem GROUP BY ALL),
o AS (SELECT g, t, t || ':' || r AS key, c FROM e UNION ALL SELECT a.g, a.t, a.t || ':' || a.r || '+' || b.r, a.c + b.c FROM e a JOIN e b ON a.g = b.g AND a.t = b.t AND b.r = a.r + 1
  UNION ALL SELECT a.g, a.t, a.t || ':' || a.r || '+' || b.r || '+' || d.r, a.c + b.c + d.c FROM e a JOIN e b ON a.g = b.g AND a.t = b.t AND b.r = a.r + 1 JOIN e d ON d.g = b.g AND d.t = b.t AND d.r = b.r + 1
  UNION ALL SELECT DISTINCT g, t, '-', 0.0 FROM e),
i AS (SELECT *, dense_rank() OVER (PARTITION BY g ORDER BY t) AS i FROM o), m AS (SELECT g, max(i) AS m FROM i GROUP BY g),
p AS (SELECT g, 0::BIGINT AS n, 0.0::DOUBLE AS c, []::VARCHAR[] AS picks FROM m UNION ALL SELECT p.g, p.n + 1, p.c + i.c, list_append(p.picks, i.key) FROM p JOIN i ON i.g = p.g AND i.i = p.n + 1),
every AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY c DESC, picks) AS rank, picks, c FROM p JOIN m USING (g) WHERE n = m AND len(list_filter(picks, lambda x: x <> '-')) > 0)"""
CHOICES = f"WITH RECURSIVE {EDGES} "
#: What a simple chooser proposes: each target's most confident single reference.
PROPOSED = "best AS (SELECT g, t, min(key) AS key, any_value(c) AS c FROM (SELECT *, t || ':' || r AS key, max(c) OVER (PARTITION BY g, t) AS most FROM e) WHERE c = most GROUP BY g, t), prop AS (SELECT g, list(key ORDER BY t) AS picks, sum(c) AS c FROM best GROUP BY g)"


def group_edges(spark, d):
    e = s.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("group_id"), (F.col("l_suppkey") % 3).alias("target_id"), (F.col("l_partkey") % 4).alias("ref_id"))
    return e.agg(F.max("l_quantity").cast("double").alias("confidence"))


def group_options(spark, d):
    e = group_edges(spark, d)
    refs = e.select("group_id", F.col("ref_id").alias("a")).distinct()
    touching = refs.join(refs.select("group_id", (F.col("a") - 1).alias("a")), ["group_id", "a"]).select("group_id", "a", (F.col("a") + 1).alias("b"))
    return choices.target_options(e, touching)


@query("q285_alternatives", CHOICES + "SELECT g AS group_id, rank, picks, c AS total FROM every")
def alternatives(spark, d):
    return choices.alternatives(group_options(spark, d), None)


@query("q143_top_alternatives", CHOICES + f"SELECT g AS group_id, rank, picks, c AS total FROM every WHERE rank <= {K}")
def top_alternatives(spark, d):
    return choices.alternatives(group_options(spark, d), K)


@query("q286_option_menu", CHOICES + f", {PROPOSED} SELECT group_id, chr((64 + row_number() OVER (PARTITION BY group_id ORDER BY rank))::INT) AS letter, picks, total, is_proposed FROM (SELECT g AS group_id, 0 AS rank, picks, c AS total, true AS is_proposed FROM prop UNION ALL SELECT x.g, x.rank, x.picks, x.c, false FROM every x LEFT JOIN prop ON prop.g = x.g AND prop.picks = x.picks WHERE x.rank <= {K} AND prop.g IS NULL)")
def option_menu(spark, d):
    key = F.concat_ws(":", "target_id", "ref_id")
    best = group_edges(spark, d).groupBy("group_id", "target_id").agg(F.min(F.struct((-F.col("confidence")).alias("cost"), key.alias("key"))).alias("m"))
    proposed = best.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("target_id", "m.key"))).alias("p"), (-F.sum("m.cost")).alias("total"))
    return choices.menu(top_alternatives(spark, d), proposed.select("group_id", F.col("p.key").alias("picks"), "total"))


@query("q279_expanded_matches")
def expanded_matches(spark, d):
    r, t = R(spark, d), T(spark, d)
    pairs = matching.scratch(matching.scored(r, t))
    out = choices.expanded(matching.scratch(matching.greedy(pairs)), pairs, r.select("id", "xy"), t.select("id", "xy"))
    return out.withColumn("confidence", F.round("confidence", 6))


@query("q274_rescued_groups")
def rescued_groups(spark, d):
    n = R(spark, d).select(F.col("id").alias("gers_id"), g.length(F.col("xy")).alias("n"))
    b = s.bridge(spark, d).join(n, "gers_id")
    members = b.select(F.col("local_id").alias("group_id"), F.col("local_id").alias("id"), F.col("gers_id").alias("ref_id"), (F.col("start_frac") * F.col("n")).alias("from_m"), (F.col("end_frac") * F.col("n")).alias("to_m"))
    return choices.rescued(members, T(spark, d).select("id", "name", "xy"))


@query("q035_candidate_graph")
def candidate_graph(spark, d):
    edges = matching.scratch(matching.scored(R(spark, d), T(spark, d)).select(F.col("ref_id").alias("u"), F.col("target_id").alias("v"), F.round("confidence", 6).alias("confidence")))
    blocks = graph.biconnected(edges.select("u", "v"))
    # a block of one edge is a bridge of its component
    alone = blocks.groupBy("block").agg((F.count("*") == 1).alias("is_bridge"))
    deg = lambda c: edges.groupBy(c).agg(F.count("*").alias(f"{c}_degree"))
    return blocks.join(alone, "block").join(edges, ["u", "v"]).join(deg("u"), "u").join(deg("v"), "v").select("u", "v", "confidence", "u_degree", "v_degree", "block", "is_bridge")


@query("q266_bridge_promotion")
def bridge_promotion(spark, d):
    # the network lacks the middle fifth of every segment, so that whole segments join what it left apart
    parts = F.array(*[F.struct(F.concat_ws(".", "id", F.lit(i)).alias("part"), g.sub_line(F.col("xy"), F.lit(a), F.lit(b)).alias("line")) for i, a, b in ((0, 0.0, 0.4), (1, 0.6, 1.0))])
    network = R(spark, d).select(F.inline(parts)).select(F.col("part").alias("id"), F.col("line").alias("xy"))
    return integration.promoted(R(spark, d).select("id", "xy"), network)


@query("q267_orphan_priority")
def orphan_priority(spark, d):
    network = R(spark, d).filter("k % 2 = 0").select("id", "xy")
    lost = matching.scratch(integration.orphans(T(spark, d), network).filter("hop IS NULL").select("id").join(T(spark, d).select("id", "xy"), "id"))
    return integration.orphan_components(lost, network).withColumn("nearest_m", F.round("nearest_m", 6))


@query("q179_name_bundle")
def name_bundle(spark, d):
    bundle = tx.name_bundle(F.col("ref_name"), F.col("target_name"))
    return sides(spark, d).select("local_id", *[(F.round(c, 6) if n in tx.MEASURES else c).alias(n) for n, c in bundle.items()])


@query("q180_name_variants")
def name_variants(spark, d):
    rule = lambda v: F.array(F.struct(v.alias("value")))
    ref = tx.variants(F.col("ref_name"), F.create_map(F.lit("en"), F.concat_ws(" ", F.lit("Old"), "ref_name")), rule(F.upper("ref_name")))
    target = tx.variants(F.col("target_name"), F.lit(None).cast("map<string,string>"), rule(F.concat_ws(" ", F.lit("Old"), "target_name")))
    named = sides(spark, d).select("local_id", ref.alias("ref"), target.alias("target"))
    return tx.best_variants(named, "local_id", "ref", "target").withColumn("ratio", F.round("ratio", 6))


#: Lines of every thirteenth key are empty, so that their features fall back to defaults.
SHAPES = f"SELECT b.local_id, CASE WHEN b.k % 13 <> 0 THEN {q.length('r.xy')} END AS a, CASE WHEN b.k % 13 <> 0 THEN {q.length('t.xy')} END AS b FROM bridge b JOIN ref r ON r.id = b.gers_id JOIN tgt t ON t.id = b.local_id"


@query("q196_feature_assembly", q.with_tables(f"SELECT local_id, round(coalesce(a, 0.0), 6) AS ref_length, round(coalesce(b, 0.0), 6) AS target_length, round(coalesce(least(a, b) / greatest(a, b), 1.0), 6) AS length_ratio, a IS NULL AND b IS NULL AS failed FROM ({SHAPES})", q.BRIDGE))
def feature_assembly(spark, d):
    line = lambda c: F.when(F.col("k") % 13 != 0, g.length(F.col(c)))
    lines = lambda rows, key, c: rows.select(F.col("id").alias(key), F.col("xy").alias(c))
    j = s.bridge(spark, d).join(lines(R(spark, d), "gers_id", "a"), "gers_id").join(lines(T(spark, d), "local_id", "b"), "local_id").select("local_id", line("a").alias("a"), line("b").alias("b"))
    contract = [("ref_length", F.round("a", 6), 0.0), ("target_length", F.round("b", 6), 0.0), ("length_ratio", F.round(F.try_divide(F.least("a", "b"), F.greatest("a", "b")), 6), 1.0)]
    # least() and greatest() skip nulls, but both lengths are null together
    return learned.assembled(j, ["local_id"], contract)


@query("q298_leave_one_out")
def leave_one_out(spark, d):
    kinds = R(spark, d).select(F.col("id").alias("ref_id"), integration.mode_of(F.col("class")).alias("kind"))
    rows = matching.scratch(labelled(spark, d).join(kinds, "ref_id"))
    return learned.leave_one_out(rows, "kind", FEATURES, trees=2, depth=2)


@query("q011_connectors", q.with_tables("SELECT id || '#0' AS id, xy[1].x AS x, xy[1].y AS y FROM ref WHERE xy[1].x BETWEEN 200 AND 900 AND xy[1].y BETWEEN 100 AND 1500 UNION ALL SELECT id || '#1', xy[-1].x, xy[-1].y FROM ref WHERE xy[-1].x BETWEEN 200 AND 900 AND xy[-1].y BETWEEN 100 AND 1500"))
def connectors(spark, d):
    ends = F.array(*[F.struct(F.concat_ws("#", "id", F.lit(i)).alias("cid"), p["x"].alias("x"), p["y"].alias("y")) for i, p in enumerate((g.first(F.col("xy")), g.last(F.col("xy"))))])
    return files.connectors(R(spark, d).select(F.inline(ends)).select(F.col("cid").alias("id"), "x", "y"), (200.0, 100.0, 900.0, 1500.0))


@query("q044_lines_only", q.with_tables("SELECT id, CASE k % 4 WHEN 0 THEN 3 ELSE 2 END AS n, xy[1].x AS x, xy[-1].y AS y FROM ref WHERE k % 4 <> 3"))
def lines_only(spark, d):
    xy, k = F.col("xy"), F.col("k") % 4
    far = F.transform(xy, lambda p, i: g.point(p["x"] + 5000, p["y"] + i * 0.5))
    cut = F.when(k == 0, F.array(F.slice(xy, 1, 2), F.slice(xy, 2, 2))).when(k == 1, F.array(xy, F.transform(F.slice(far, 1, 1), lambda p: p))).otherwise(F.array(xy))
    rows = R(spark, d).select("id", F.when(k < 2, "MultiLineString").when(k == 2, "LineString").otherwise("Point").alias("kind"), cut.alias("parts"))
    return files.lines_only(rows).select("id", F.size("xy").alias("n"), g.first(xy)["x"].alias("x"), g.last(xy)["y"].alias("y"))


#: Rules of a customer: a short name over its first half, a common one over the first quarter of every second, a speed in miles over the second half.
@query("q225_parsed_names", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN ['0.0:common', '0.25:short', '0.5:' || c_mktsegment] ELSE ['0.0:short', '0.5:' || c_mktsegment] END AS spans FROM customer")
def parsed_names(spark, d):
    rule = lambda value, variant, end: F.struct(F.lit(value).alias("value"), F.lit(variant).alias("variant"), F.lit(None).cast("string").alias("language"), F.array(F.lit(0.0), F.lit(end)).alias("between"))
    rules = F.array_compact(F.array(rule("short", "short", 0.5), F.when(F.col("c_custkey") % 2 == 0, rule("common", "common", 0.25))))
    return s.table(spark, d, "customer").select("c_custkey", F.transform(ranges.names(F.col("c_mktsegment"), rules), lambda r: F.concat_ws(":", r["start"], r["value"])).alias("spans"))


@query("q225_parsed_speeds", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '0.5-1.0:' || CASE WHEN c_custkey % 2 = 0 THEN round((c_custkey % 60 + 5) * 1.609344)::INT ELSE c_custkey % 60 + 5 END ELSE '' END AS spans FROM customer")
def parsed_speeds(spark, d):
    k = F.col("c_custkey")
    rule = F.struct((k % 60 + 5).alias("value"), F.when(k % 2 == 0, "mph").otherwise("km/h").alias("unit"), F.array(F.lit(0.5), F.lit(1.0)).alias("between"))
    known = F.filter(ranges.speeds(F.array_compact(F.array(F.when(k % 3 == 0, rule)))), lambda r: r["value"].isNotNull())
    return s.table(spark, d, "customer").select("c_custkey", F.array_join(F.transform(known, lambda r: F.concat(r["start"], F.lit("-"), r["end"], F.lit(":"), r["value"])), ",").alias("spans"))


ACCESS = "SELECT c_custkey, 'footway' AS class, CASE c_custkey % 4 WHEN 0 THEN 'denied' WHEN 1 THEN 'allowed' WHEN 2 THEN 'permit' END AS kind, c_custkey % 3 = 0 AS scoped FROM customer"


@query("q225_parsed_access", f"SELECT c_custkey, CASE WHEN kind IS NULL THEN NULL WHEN scoped OR kind = 'permit' THEN 'restricted/tagged' ELSE kind || '/tagged' END AS bicycle, 'designated/class_default' AS foot FROM ({ACCESS})")
def parsed_access(spark, d):
    s.table(spark, d, "customer").createOrReplaceTempView("customer")
    rule = F.struct(F.col("kind").alias("access_type"), F.array(F.lit("bicycle")).alias("modes"), "scoped", F.lit(None).cast("array<double>").alias("between"))
    value = F.get(ranges.access(F.array(rule), F.col("class")), F.lit(0))["value"]
    return spark.sql(ACCESS).select("c_custkey", value["bicycle"].alias("bicycle"), value["foot"].alias("foot"))
