"""Joins, aggregations, windows and set operations over segments, bridges and truth tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import ranges
from ..operators import bridges
from ..sources import synthetic as s
from . import sqltext as q
from .registry import query

W = lambda body, *more: q.with_tables(body, q.BRIDGE, *more)


@query("q003_column_pruned_scan", "SELECT o_orderkey, o_orderstatus FROM orders")
def column_pruned_scan(spark, d):
    return s.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")


@query("q028_row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return s.table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query("q008_key_validation", W("SELECT gers_id, count(*) AS n FROM bridge GROUP BY gers_id HAVING count(*) > 1"))
def key_validation(spark, d):
    return bridges.duplicate_keys(s.bridge(spark, d), ["gers_id"])


@query("q031_unmatched_sink", W("SELECT t.id AS local_id, t.name, t.class, CASE WHEN EXISTS (SELECT 1 FROM decided d WHERE d.local_id = t.id AND d.decision = 'review') THEN 'low_confidence_review' ELSE 'no_match_found' END AS unmatched_reason FROM tgt t WHERE t.id NOT IN (SELECT local_id FROM decided WHERE decision = 'match')"))
def unmatched_sink(spark, d):
    return bridges.unmatched(s.target(spark, d).select("id", "name", "class"), s.bridge(spark, d))


@query("q032_review_sink", W("SELECT d.local_id, d.gers_id, d.confidence, r.class AS ref_class, t.class AS target_class FROM decided d JOIN ref r ON r.id = d.gers_id JOIN tgt t ON t.id = d.local_id WHERE decision = 'review'"))
def review_sink(spark, d):
    return bridges.with_sides(s.bridge(spark, d).filter("decision = 'review'"), s.reference(spark, d), s.target(spark, d)).select("local_id", "gers_id", "confidence", "ref_class", "target_class")


TWO = "two AS (SELECT local_id, gers_id, confidence FROM bridge UNION ALL SELECT local_id, gers_id || 'x', round(1 - confidence, 2) FROM bridge)"


@query("q033_merge_bridges", W("SELECT local_id, gers_id, confidence FROM two QUALIFY row_number() OVER (PARTITION BY local_id ORDER BY confidence DESC, gers_id) = 1", TWO))
def merge_bridges(spark, d):
    b = s.bridge(spark, d).select("local_id", "gers_id", "confidence")
    other = b.select("local_id", F.concat("gers_id", F.lit("x")).alias("gers_id"), F.round(1 - F.col("confidence"), 2).alias("confidence"))
    return bridges.merged([b, other], "highest_confidence")


@query("q037_unified_long_table", W("SELECT 'a' AS dataset, local_id, gers_id, confidence FROM bridge UNION ALL SELECT 'b', local_id, gers_id, confidence FROM bridge WHERE k % 2 = 0"))
def unified_long_table(spark, d):
    b = s.bridge(spark, d)
    return bridges.unified({"a": b, "b": b.filter("k % 2 = 0")}).select("dataset", "local_id", "gers_id", "confidence")


@query("q046_schema_normalise", "SELECT 'seg-' || c_custkey || '-x' AS local_id, lower(trim(c_mktsegment)) AS class FROM customer QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) = 1")
def schema_normalise(spark, d):
    c = s.table(spark, d, "customer")
    first = Window.partitionBy("c_custkey").orderBy("c_name")
    return c.withColumn("rn", F.row_number().over(first)).filter("rn = 1").select(F.concat(F.lit("seg-"), "c_custkey", F.lit("-x")).alias("local_id"), F.lower(F.trim("c_mktsegment")).alias("class"))


@query("q055_exclude_values", q.with_tables("SELECT id, class FROM ref WHERE class NOT IN ('footway', 'service')"))
def exclude_values(spark, d):
    return s.reference(spark, d).filter(~F.col("class").isin("footway", "service")).select("id", "class")


@query("q065_confidence_band", W("SELECT b.local_id, b.confidence FROM bridge b WHERE confidence BETWEEN 0.3 AND 0.7 AND NOT EXISTS (SELECT 1 FROM truth t WHERE t.local_id = b.local_id)"))
def confidence_band(spark, d):
    return s.bridge(spark, d).filter(F.col("confidence").between(0.3, 0.7)).join(s.truth(spark, d), "local_id", "left_anti").select("local_id", "confidence")


@query("q081_feature_left_join", W("SELECT b.local_id, coalesce(t.label, 'none') AS label FROM bridge b LEFT JOIN truth t USING (gers_id, local_id)"))
def feature_left_join(spark, d):
    return s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"], "left").select("local_id", F.coalesce("label", F.lit("none")).alias("label"))


@query("q082_label_feature_join", W("SELECT t.gers_id, t.local_id, t.label, d.decision FROM truth t JOIN decided d USING (gers_id, local_id)"))
def label_feature_join(spark, d):
    return s.truth(spark, d).join(s.bridge(spark, d).select("gers_id", "local_id", "decision"), ["gers_id", "local_id"])


@query("q084_truth_left_join", W("SELECT b.local_id, t.label FROM (SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY local_id ORDER BY confidence DESC, gers_id) = 1) b LEFT JOIN truth t USING (gers_id, local_id)", TWO))
def truth_left_join(spark, d):
    return merge_bridges(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"], "left").select("local_id", "label")


@query("q085_class_confusion", W("SELECT r.class AS ref_class, t.class AS target_class, count(*) AS n FROM bridge b JOIN ref r ON r.id = b.gers_id JOIN tgt t ON t.id = b.local_id GROUP BY ALL"))
def class_confusion(spark, d):
    return bridges.with_sides(s.bridge(spark, d), s.reference(spark, d), s.target(spark, d)).groupBy("ref_class", "target_class").agg(F.count("*").alias("n"))


@query("q107_class_crosstab", W("SELECT r.class AS ref_class, count(*) FILTER (confidence >= 0.5) AS high, count(*) FILTER (confidence < 0.5) AS low FROM bridge b JOIN ref r ON r.id = b.gers_id GROUP BY ALL"))
def class_crosstab(spark, d):
    both = s.bridge(spark, d).join(s.reference(spark, d).select(F.col("id").alias("gers_id"), F.col("class").alias("ref_class")), "gers_id")
    return both.groupBy("ref_class").agg(F.count_if(F.col("confidence") >= 0.5).alias("high"), F.count_if(F.col("confidence") < 0.5).alias("low"))


@query("q087_bridge_consumer", W("SELECT r.class, count(*) AS n_orders, count(*) FILTER (o.o_orderstatus = 'F') AS n_f, round(max(o.o_totalprice), 2) AS top_price FROM orders o JOIN bridge b ON b.k = o.o_custkey JOIN ref r ON r.id = b.gers_id WHERE b.confidence >= 0.5 GROUP BY r.class"))
def bridge_consumer(spark, d):
    o, b, r = s.table(spark, d, "orders"), s.bridge(spark, d), s.reference(spark, d)
    return spark.sql(
        "SELECT r.class, count(*) AS n_orders, count(*) FILTER (WHERE o.o_orderstatus = 'F') AS n_f, round(max(o.o_totalprice), 2) AS top_price "
        "FROM {o} o JOIN {b} b ON b.k = o.o_custkey JOIN {r} r ON r.id = b.gers_id WHERE b.confidence >= 0.5 GROUP BY r.class",
        o=o, b=b, r=r,
    )


@query("q088_ad_hoc_join", W(f"SELECT b.local_id, r.class FROM bridge b JOIN ref r ON r.id = b.gers_id WHERE {q.bbox('r.xy', 'min', 'x')} < 300"))
def ad_hoc_join(spark, d):
    r = s.reference(spark, d).withColumn("bbox", g.bbox(F.col("xy")))
    return spark.sql("WITH near AS (SELECT id, class FROM {r} WHERE bbox.xmin < 300) SELECT b.local_id, n.class FROM {b} b JOIN near n ON n.id = b.gers_id", r=r, b=s.bridge(spark, d))


@query("q089_anti_join", W("SELECT id FROM tgt WHERE id NOT IN (SELECT local_id FROM decided WHERE decision = 'match')"))
def anti_join(spark, d):
    return s.target(spark, d).join(s.bridge(spark, d).filter("decision = 'match'").select(F.col("local_id").alias("id")), "id", "left_anti").select("id")


CHURN = "old AS (SELECT local_id, gers_id FROM bridge WHERE k % 4 <> 1), new AS (SELECT local_id, CASE WHEN k % 6 = 0 THEN gers_id || 'n' ELSE gers_id END AS gers_id FROM bridge WHERE k % 4 <> 2)"


@query("q090_churn", W("SELECT coalesce(o.local_id, n.local_id) AS local_id, CASE WHEN o.g IS NULL THEN 'gained' WHEN n.g IS NULL THEN 'lost' WHEN o.g = n.g THEN 'same' ELSE 'changed' END AS category, coalesce(o.g, '') AS from_gers, coalesce(n.g, '') AS to_gers FROM (SELECT local_id, string_agg(DISTINCT gers_id, ';' ORDER BY gers_id) AS g FROM old GROUP BY 1) o FULL JOIN (SELECT local_id, string_agg(DISTINCT gers_id, ';' ORDER BY gers_id) AS g FROM new GROUP BY 1) n USING (local_id)", CHURN))
def churn(spark, d):
    b = s.bridge(spark, d)
    new = b.filter("k % 4 <> 2").withColumn("gers_id", F.when(F.col("k") % 6 == 0, F.concat("gers_id", F.lit("n"))).otherwise(F.col("gers_id")))
    return bridges.churn(b.filter("k % 4 <> 1"), new)


@query("q095_class_distribution", q.with_tables("SELECT coalesce(class, 'unknown') AS class, count(*) AS n FROM ref GROUP BY 1"))
def class_distribution(spark, d):
    return s.reference(spark, d).groupBy(F.coalesce("class", F.lit("unknown")).alias("class")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "class")


@query("q096_name_coverage", q.with_tables("SELECT round(avg(CASE WHEN trim(coalesce(name, '')) <> '' THEN 1.0 ELSE 0.0 END), 6) AS name_coverage, round(avg(CASE WHEN class <> 'service' THEN 1.0 ELSE 0.0 END), 6) AS class_coverage FROM ref"))
def name_coverage(spark, d):
    return s.reference(spark, d).agg(F.round(F.avg((F.trim(F.coalesce("name", F.lit(""))) != "").cast("double")), 6).alias("name_coverage"), F.round(F.avg((F.col("class") != "service").cast("double")), 6).alias("class_coverage"))


N = q.length("xy")


@query("q097_length_distribution", q.with_tables(f"SELECT round(min(n), 6) AS shortest, round(max(n), 6) AS longest, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.95), 6) AS p95 FROM (SELECT {N} AS n FROM ref)"))
def length_distribution(spark, d):
    n = s.reference(spark, d).select(g.length(F.col("xy")).alias("n"))
    return n.agg(*[F.round(e, 6).alias(a) for a, e in (("shortest", F.min("n")), ("longest", F.max("n")), ("mean", F.avg("n")), ("median", F.percentile("n", 0.5)), ("p95", F.percentile("n", 0.95)))])


@query("q098_vertex_density_stats", q.with_tables(f"SELECT round(sum(len(xy)) / sum({N}), 6) AS per_metre, round(avg(len(xy)), 6) AS mean_vertices, round(quantile_cont(len(xy) / {N}, 0.5), 6) AS median_density FROM ref WHERE {N} > 0"))
def vertex_density_stats(spark, d):
    v = s.reference(spark, d).select(F.size("xy").alias("v"), g.length(F.col("xy")).alias("n")).filter("n > 0")
    return v.agg(F.round(F.sum("v") / F.sum("n"), 6).alias("per_metre"), F.round(F.avg("v"), 6).alias("mean_vertices"), F.round(F.percentile(F.col("v") / F.col("n"), 0.5), 6).alias("median_density"))


@query("q102_invalid_geometry", q.with_tables(f"SELECT count(*) FILTER (len(xy) < 2 OR {N} = 0) AS invalid, count(*) AS n FROM ref"))
def invalid_geometry(spark, d):
    return s.reference(spark, d).agg(F.count_if((F.size("xy") < 2) | (g.length(F.col("xy")) == 0)).alias("invalid"), F.count("*").alias("n"))


@query("q103_quality_fingerprint", q.with_tables(f"SELECT count(*) AS n, round(sum({N}), 3) AS total_m, round(avg(CASE WHEN trim(coalesce(name, '')) <> '' THEN 1.0 ELSE 0.0 END), 6) AS name_coverage, count(DISTINCT class) AS n_classes, round(quantile_cont({N}, 0.5), 6) AS median_m FROM ref"))
def quality_fingerprint(spark, d):
    return bridges.fingerprint(s.reference(spark, d))


@query("q105_fingerprint_compare", q.with_tables("SELECT a.n AS n_a, b.n AS n_b, round(b.c - a.c, 6) AS coverage_change, b.c - a.c < -0.3 OR abs(b.n - a.n) > 0.5 * a.n AS failed FROM (SELECT count(*) AS n, avg(CASE WHEN trim(coalesce(name, '')) <> '' THEN 1.0 ELSE 0.0 END) AS c FROM ref) a, (SELECT count(*) AS n, avg(CASE WHEN trim(coalesce(name, '')) <> '' THEN 1.0 ELSE 0.0 END) AS c FROM tgt) b"))
def fingerprint_compare(spark, d):
    return bridges.compare_fingerprints(bridges.fingerprint(s.reference(spark, d)), bridges.fingerprint(s.target(spark, d)))


@query("q106_column_profiling", "SELECT col, value, n FROM (SELECT 'status' AS col, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2) QUALIFY row_number() OVER (PARTITION BY col ORDER BY n DESC, value) <= 3")
def column_profiling(spark, d):
    return bridges.profile(s.table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")), 3)


@query("q108_label_counts", W("SELECT label, count(*) AS n FROM truth GROUP BY label"))
def label_counts(spark, d):
    return s.truth(spark, d).groupBy("label").agg(F.count("*").alias("n"))


@query("q109_filtered_aggregates", "SELECT l_returnflag, count(*) FILTER (l_quantity > 25) AS n_large, max(l_discount) AS top_discount, count(DISTINCT l_linenumber) AS lines FROM lineitem GROUP BY l_returnflag")
def filtered_aggregates(spark, d):
    return spark.sql("SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS n_large, max(l_discount) AS top_discount, count(DISTINCT l_linenumber) AS lines FROM {l} GROUP BY l_returnflag", l=s.table(spark, d, "lineitem"))


@query("q110_decision_summary", W("SELECT decision, count(*) AS n, round(avg(confidence), 3) AS mean_confidence FROM decided GROUP BY decision"))
def decision_summary(spark, d):
    return s.bridge(spark, d).groupBy("decision").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 3).alias("mean_confidence")).orderBy("decision")


PRF = "SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS p, round(tp / (tp + fn), 6) AS r, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (SELECT count(*) FILTER (said AND label = 'match') AS tp, count(*) FILTER (said AND label = 'no_match') AS fp, count(*) FILTER (NOT said AND label = 'match') AS fn FROM (SELECT t.label, d.decision = 'match' AS said FROM truth t JOIN decided d USING (gers_id, local_id)))"


@query("q112_prf_pairs", W(PRF))
def prf_pairs(spark, d):
    return bridges.prf(s.bridge(spark, d).filter("decision = 'match'"), s.truth(spark, d))


@query("q116_blocking_recall", W("SELECT count(*) AS labelled, count(*) FILTER (kept) AS retained, round(count(*) FILTER (kept) / count(*), 6) AS recall FROM (SELECT EXISTS (SELECT 1 FROM bridge b WHERE b.local_id = t.local_id AND b.k % 5 <> 0) AS kept FROM truth t WHERE label = 'match')"))
def blocking_recall(spark, d):
    return bridges.blocking_recall(s.bridge(spark, d).filter("k % 5 <> 0"), s.truth(spark, d))


@query("q117_calibration_error", W("SELECT round(sum(abs(p - y) * n) / sum(n), 6) AS ece, round(sum(b) / sum(n), 6) AS brier FROM (SELECT least(floor(confidence * 10), 9) AS bin, count(*) AS n, avg(confidence) AS p, avg(CASE WHEN label = 'match' THEN 1.0 ELSE 0.0 END) AS y, sum(power(confidence - CASE WHEN label = 'match' THEN 1.0 ELSE 0.0 END, 2)) AS b FROM bridge JOIN truth USING (gers_id, local_id) GROUP BY 1)"))
def calibration_error(spark, d):
    p = s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"]).select(F.col("confidence").alias("p"), (F.col("label") == "match").cast("double").alias("y"))
    return bridges.calibration_error(p)


@query("q118_bootstrap_interval")
def bootstrap_interval(spark, d):
    p = s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"]).select("gers_id", ((F.col("label") == "match") == (F.col("decision") == "match")).cast("double").alias("v"))
    return bridges.bootstrap(p, "gers_id", "v", 200)


@query("q125_range_merge", W("SELECT gers_id, min(s) AS start, max(e) AS \"end\" FROM (SELECT *, sum(f) OVER (PARTITION BY gers_id ORDER BY s, e) AS i FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY gers_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 0.01 THEN 0 ELSE 1 END AS f FROM (SELECT gers_id, start_frac * 0.8 AS s, end_frac * 0.6 AS e FROM bridge WHERE end_frac * 0.6 > start_frac * 0.8))) GROUP BY gers_id, i"))
def range_merge(spark, d):
    b = s.bridge(spark, d).select("gers_id", (F.col("start_frac") * 0.8).alias("start"), (F.col("end_frac") * 0.6).alias("end"))
    return ranges.merge(b, "gers_id")


PART = "m AS (SELECT gers_id, min(start_frac) * 0.5 + 0.1 AS s, max(end_frac) * 0.5 + 0.1 AS e FROM bridge GROUP BY gers_id)"


@query("q126_range_complement", W("SELECT gers_id, 0.0::DOUBLE AS start, round(s, 6) AS \"end\" FROM m UNION ALL SELECT gers_id, round(e, 6), 1.0 FROM m", PART))
def range_complement(spark, d):
    m = s.bridge(spark, d).groupBy("gers_id").agg((F.min("start_frac") * 0.5 + 0.1).alias("start"), (F.max("end_frac") * 0.5 + 0.1).alias("end"))
    return ranges.complement(m, "gers_id").select("gers_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query("q127_interval_union", W("SELECT gers_id, round(sum(end_frac - start_frac), 6) AS covered FROM bridge GROUP BY gers_id"))
def interval_union(spark, d):
    b = s.bridge(spark, d).select("gers_id", F.col("start_frac").alias("start"), F.col("end_frac").alias("end"))
    return ranges.covered(ranges.merge(b, "gers_id"), "gers_id").withColumn("covered", F.round("covered", 6))


@query("q128_error_aggregation", "SELECT event_type AS phase, count(*) AS n, count(*) FILTER (value < 5) AS errors, count(*) FILTER (value < 5) > 0.2 * count(*) AS failed FROM events GROUP BY 1")
def error_aggregation(spark, d):
    e = s.table(spark, d, "events").groupBy(F.col("event_type").alias("phase")).agg(F.count("*").alias("n"), F.count_if(F.col("value") < 5).alias("errors"))
    return e.withColumn("failed", F.col("errors") > 0.2 * F.col("n"))


@query("q129_grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
def grouping_sets(spark, d):
    return s.table(spark, d, "lineitem").groupingSets([["l_returnflag", "l_linestatus"], ["l_returnflag"], []], "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("q131_best_per_key", W("SELECT gers_id, local_id FROM bridge QUALIFY row_number() OVER (PARTITION BY gers_id ORDER BY confidence DESC, end_frac - start_frac DESC, local_id) = 1"))
def best_per_key(spark, d):
    w = Window.partitionBy("gers_id").orderBy(F.desc("confidence"), F.desc(F.col("end_frac") - F.col("start_frac")), "local_id")
    return s.bridge(spark, d).withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("gers_id", "local_id")


@query("q132_group_relative", W("SELECT local_id, round(confidence - max(confidence) OVER g, 6) AS below_best, round(confidence - avg(confidence) OVER g, 6) AS above_mean, confidence = min(confidence) OVER g AS is_least, count(*) OVER g AS n_share FROM bridge WINDOW g AS (PARTITION BY k % 50)"))
def group_relative(spark, d):
    w = Window.partitionBy(F.col("k") % 50)
    c = F.col("confidence")
    return s.bridge(spark, d).select("local_id", F.round(c - F.max(c).over(w), 6).alias("below_best"), F.round(c - F.avg(c).over(w), 6).alias("above_mean"), (c == F.min(c).over(w)).alias("is_least"), F.count("*").over(w).alias("n_share"))


@query("q133_competition_margin", W("SELECT local_id, round(confidence - lead(confidence) OVER (PARTITION BY k % 50 ORDER BY confidence DESC, local_id), 6) AS margin FROM bridge"))
def competition_margin(spark, d):
    w = Window.partitionBy(F.col("k") % 50).orderBy(F.desc("confidence"), "local_id")
    return s.bridge(spark, d).select("local_id", F.round(F.col("confidence") - F.lead("confidence").over(w), 6).alias("margin"))


@query("q135_keep_last", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def keep_last(spark, d):
    return s.table(spark, d, "events").groupBy("user_id").agg(F.max(F.struct("event_id", "event_type")).alias("m")).select("user_id", "m.event_id", "m.event_type")


@query("q138_exact_percentile", "SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.95), 4) AS p95 FROM orders GROUP BY 1")
def exact_percentile(spark, d):
    return s.table(spark, d, "orders").groupBy("o_orderpriority").agg(F.round(F.percentile("o_totalprice", 0.25), 4).alias("p25"), F.round(F.percentile("o_totalprice", 0.95), 4).alias("p95"))


@query("q140_paged_query", W("SELECT local_id, confidence FROM bridge WHERE confidence > 0.2 ORDER BY confidence DESC, local_id LIMIT 20 OFFSET 40"))
def paged_query(spark, d):
    return s.bridge(spark, d).filter("confidence > 0.2").orderBy(F.desc("confidence"), "local_id").offset(40).limit(20).select("local_id", "confidence")


@query("q141_reverse_lookup", W("SELECT gers_id, local_id, confidence FROM bridge WHERE gers_id IN ('r15', 'r30')"))
def reverse_lookup(spark, d):
    return s.bridge(spark, d).filter(F.col("gers_id").isin("r15", "r30")).select("gers_id", "local_id", "confidence")


@query("q142_top_report", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10")
def top_report(spark, d):
    return s.table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_nationkey").limit(10)


@query("q144_stratified_sample")
def stratified_sample(spark, d):
    return bridges.stratified(s.bridge(spark, d), F.floor(F.col("confidence") * 5), "local_id", 10)


@query("q146_holdout")
def holdout(spark, d):
    return s.bridge(spark, d).filter(F.pmod(F.xxhash64("local_id", F.lit(42)), F.lit(1000)) >= 200).select("local_id", "gers_id")


@query("q147_union_by_name", W("SELECT local_id AS id, confidence, NULL AS class FROM bridge UNION ALL SELECT id, NULL, class FROM tgt"))
def union_by_name(spark, d):
    return s.bridge(spark, d).select(F.col("local_id").alias("id"), "confidence").unionByName(s.target(spark, d).select("id", "class"), allowMissingColumns=True)


@query("q148_set_operations", W("SELECT local_id, gers_id, 'both' AS side FROM (SELECT local_id, gers_id FROM bridge WHERE k % 2 = 0 INTERSECT SELECT local_id, gers_id FROM bridge WHERE k % 5 = 0) UNION ALL SELECT local_id, gers_id, 'left' FROM (SELECT local_id, gers_id FROM bridge WHERE k % 2 = 0 EXCEPT SELECT local_id, gers_id FROM bridge WHERE k % 5 = 0)"))
def set_operations(spark, d):
    b = s.bridge(spark, d)
    x, y = b.filter("k % 2 = 0").select("local_id", "gers_id"), b.filter("k % 5 = 0").select("local_id", "gers_id")
    return x.intersect(y).withColumn("side", F.lit("both")).unionAll(x.subtract(y).withColumn("side", F.lit("left")))


@query("q149_universe_product", W("SELECT a.gers_id, b.local_id FROM (SELECT DISTINCT k % 200 AS gr, gers_id FROM bridge) a JOIN (SELECT DISTINCT k % 200 AS gr, local_id FROM bridge) b USING (gr) WHERE EXISTS (SELECT 1 FROM bridge c WHERE c.gers_id = a.gers_id AND c.local_id = b.local_id)"))
def universe_product(spark, d):
    b = s.bridge(spark, d).withColumn("gr", F.col("k") % 200)
    # starts from the pairs that are kept in the end, as the product grows with the square of a group
    pairs = b.select("gers_id", "local_id").distinct()
    return pairs.join(b.select("gr", "gers_id").distinct(), "gers_id").join(b.select("gr", "local_id").distinct(), ["gr", "local_id"]).select("gers_id", "local_id")


@query("q150_lag_over_time", "SELECT event_id, event_type, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events")
def lag_over_time(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return s.table(spark, d, "events").select("event_id", "event_type", (F.col("event_id") - F.lag("event_id").over(w)).alias("step"))


@query("q093_as_of_join", "SELECT o_orderkey, max(l_linenumber) AS last_line FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate <= o_orderdate + INTERVAL 60 DAY GROUP BY o_orderkey")
def as_of_join(spark, d):
    o, ln = s.table(spark, d, "orders"), s.table(spark, d, "lineitem")
    return o.join(ln, (o.o_orderkey == ln.l_orderkey) & (ln.l_shipdate <= o.o_orderdate + F.expr("INTERVAL 60 DAY"))).groupBy("o_orderkey").agg(F.max("l_linenumber").alias("last_line"))


@query("q260_separate_matched", W("SELECT t.id, t.id IN (SELECT local_id FROM decided WHERE decision = 'match') AS matched FROM tgt t"))
def separate_matched(spark, d):
    hit = s.bridge(spark, d).filter("decision = 'match'").select(F.col("local_id").alias("id")).distinct().withColumn("matched", F.lit(True))
    return s.target(spark, d).join(hit, "id", "left").select("id", F.coalesce("matched", F.lit(False)).alias("matched"))


@query("q288_target_decisions", W("SELECT local_id, CASE WHEN bool_or(decision = 'match') THEN 'match' WHEN bool_or(decision = 'review') THEN 'review' END AS part FROM decided GROUP BY local_id HAVING bool_or(decision <> 'no_match')"))
def target_decisions(spark, d):
    b = s.bridge(spark, d).filter("decision <> 'no_match'")
    return b.groupBy("local_id").agg(F.when(F.bool_or(F.col("decision") == "match"), "match").otherwise("review").alias("part"))


@query("q299_evaluate_by_dataset", W(PRF.replace("SELECT tp, fp, fn", "SELECT dataset, tp, fp, fn").replace("FROM (SELECT count(*)", "FROM (SELECT dataset, count(*)").replace("SELECT t.label", "SELECT 'd' || (d.k % 3) AS dataset, t.label").replace("(gers_id, local_id)))", "(gers_id, local_id)) GROUP BY dataset)")))
def evaluate_by_dataset(spark, d):
    b = s.bridge(spark, d)
    t = s.truth(spark, d).join(b.select("gers_id", "local_id", F.concat(F.lit("d"), F.col("k") % 3).alias("dataset")), ["gers_id", "local_id"])
    return bridges.prf(b.filter("decision = 'match'"), t, "dataset")


@query("q296_version_gate", "SELECT o_orderstatus AS version, count(*) AS n, o_orderstatus <> 'O' AS stale FROM orders GROUP BY 1")
def version_gate(spark, d):
    return s.table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("version")).agg(F.count("*").alias("n")).withColumn("stale", F.col("version") != "O")


@query("q297_row_fingerprint", "SELECT sha256(string_agg(h, '' ORDER BY h)) AS fingerprint FROM (SELECT sha256(s_suppkey::VARCHAR || '|' || s_name) AS h FROM supplier)")
def row_fingerprint(spark, d):
    h = s.table(spark, d, "supplier").select(F.sha2(F.concat_ws("|", "s_suppkey", "s_name"), 256).alias("h"))
    return h.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("fingerprint"))
