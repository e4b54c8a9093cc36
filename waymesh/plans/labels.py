"""Votes, consensus, label stores and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as lb
from ..sources import synthetic as s
from . import sqltext as q
from .registry import query

W = lambda body, *more: q.with_tables(body, q.BRIDGE, q.VOTES, *more)
LATEST = "ballots AS (SELECT group_id, seat, choice, conf FROM votes QUALIFY row_number() OVER (PARTITION BY group_id, seat ORDER BY ts DESC, vote_id DESC) = 1)"


def ballots(spark, d):
    return lb.latest(s.votes(spark, d), "group_id", "seat")


@query("q136_latest_ballot", W("SELECT group_id, seat, choice FROM ballots", LATEST))
def latest_ballot(spark, d):
    return ballots(spark, d).select("group_id", "seat", "choice")


@query("q137_latest_panel", W("SELECT group_id, choice FROM votes QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY ts DESC, vote_id DESC) = 1"))
def latest_panel(spark, d):
    return lb.latest(s.votes(spark, d), "group_id").select("group_id", "choice")


CONS = """per AS (SELECT group_id, choice, count(*) AS n, avg(conf) AS c FROM ballots WHERE choice <> 'view' GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY n DESC, choice) AS rn, sum(n) OVER (PARTITION BY group_id) AS nv FROM per),
abst AS (SELECT group_id, count(*) FILTER (choice = 'view') AS a FROM ballots GROUP BY 1)"""


@query("q120_consensus", W("SELECT r.group_id, r.nv::BIGINT AS n_valid, r.n AS top, r.choice, round(r.c + 1e-9, 3) AS mean_confidence, CASE WHEN r.n = r.nv AND r.nv >= 3 AND a = 0 THEN 'unanimous' WHEN r.n = r.nv AND r.nv >= 3 THEN 'quorum' WHEN r.n >= 2 THEN 'majority' ELSE 'none' END AS tier, coalesce((SELECT string_agg(x.choice, ',' ORDER BY x.choice) FROM rk x WHERE x.group_id = r.group_id AND x.rn > 1), '') AS minority FROM rk r JOIN abst USING (group_id) WHERE rn = 1", LATEST, CONS))
def consensus(spark, d):
    return lb.consensus(ballots(spark, d), "view")


@query("q119_voter_statistics", W("SELECT seat, count(*) AS n, round(stddev_samp(conf), 6) AS spread, round(avg(conf), 6) AS mean FROM votes GROUP BY seat"))
def voter_statistics(spark, d):
    return s.votes(spark, d).groupBy("seat").agg(F.count("*").alias("n"), F.round(F.stddev_samp("conf"), 6).alias("spread"), F.round(F.avg("conf"), 6).alias("mean"))


@query("q121_desired_sets", W("SELECT group_id, choice, count(DISTINCT seat) AS seats FROM ballots b WHERE choice <> 'click' GROUP BY 1, 2 HAVING count(DISTINCT seat) >= 2", LATEST))
def desired_sets(spark, d):
    return ballots(spark, d).filter("choice <> 'click'").groupBy("group_id", "choice").agg(F.count_distinct("seat").alias("seats")).filter("seats >= 2")


@query("q122_soft_labels", W("SELECT group_id, round(sum((seat + 1) * CASE WHEN choice = 'click' THEN 1 ELSE 0 END) / sum(seat + 1), 6) AS keep FROM ballots GROUP BY 1", LATEST))
def soft_labels(spark, d):
    w = F.col("seat") + 1
    return ballots(spark, d).groupBy("group_id").agg(F.round(F.sum(w * F.when(F.col("choice") == "click", 1).otherwise(0)) / F.sum(w), 6).alias("keep"))


@query("q123_vote_observations", W("SELECT group_id, count(*) AS seats, count(DISTINCT choice) AS choices FROM ballots WHERE seat IN (SELECT seat FROM votes GROUP BY seat HAVING count(DISTINCT choice) > 1) GROUP BY 1", LATEST))
def vote_observations(spark, d):
    fine = s.votes(spark, d).groupBy("seat").agg(F.count_distinct("choice").alias("c")).filter("c > 1")
    return ballots(spark, d).join(fine, "seat", "left_semi").groupBy("group_id").agg(F.count("*").alias("seats"), F.count_distinct("choice").alias("choices"))


@query("q124_quarantine", W("SELECT group_id, min(choice) AS label, count(*) AS n, count(DISTINCT choice) > 1 AS quarantined FROM ballots GROUP BY 1", LATEST))
def quarantine(spark, d):
    return lb.quarantine(ballots(spark, d).withColumnRenamed("choice", "label"), "group_id")


@query("q311_disagreements", W("SELECT group_id, string_agg(DISTINCT choice, ',' ORDER BY choice) AS labels FROM ballots GROUP BY 1 HAVING count(DISTINCT choice) > 1", LATEST))
def disagreements(spark, d):
    return ballots(spark, d).groupBy("group_id").agg(F.array_sort(F.collect_set("choice")).alias("l")).filter("size(l) > 1").select("group_id", F.array_join("l", ",").alias("labels"))


@query("q114_group_exact_rate", W("SELECT round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS exact_rate FROM (SELECT d.k % 50 AS g, bool_and((d.decision = 'match') = (t.label = 'match')) AS ok FROM decided d JOIN truth t USING (gers_id, local_id) GROUP BY 1)"))
def group_exact_rate(spark, d):
    x = s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"]).groupBy(F.col("k") % 50).agg(F.bool_and((F.col("decision") == "match") == (F.col("label") == "match")).alias("ok"))
    return x.agg(F.round(F.avg(F.col("ok").cast("double")), 6).alias("exact_rate"))


@query("q115_set_metrics", W("SELECT g, len(list_intersect(p, y)) AS tp, len(p) - len(list_intersect(p, y)) AS fp, len(y) - len(list_intersect(p, y)) AS fn FROM (SELECT d.k % 50 AS g, coalesce(list(DISTINCT d.local_id) FILTER (d.decision = 'match'), []) AS p, coalesce(list(DISTINCT d.local_id) FILTER (t.label = 'match'), []) AS y FROM decided d JOIN truth t USING (gers_id, local_id) GROUP BY 1)"))
def set_metrics(spark, d):
    x = s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"]).groupBy((F.col("k") % 50).alias("g"))
    x = x.agg(F.collect_set(F.when(F.col("decision") == "match", F.col("local_id"))).alias("p"), F.collect_set(F.when(F.col("label") == "match", F.col("local_id"))).alias("y"))
    tp = F.size(F.array_intersect("p", "y"))
    return x.select("g", tp.cast("long").alias("tp"), (F.size("p") - tp).cast("long").alias("fp"), (F.size("y") - tp).cast("long").alias("fn"))


@query("q130_slice_report", W("SELECT CASE WHEN grouping(ds) = 1 THEN 'all' ELSE ds END AS slice, count(*) AS n, count(*) FILTER (label = 'match') AS positives FROM (SELECT 'd' || (d.k % 3) AS ds, t.label FROM decided d JOIN truth t USING (gers_id, local_id)) GROUP BY ROLLUP (ds)"))
def slice_report(spark, d):
    x = s.bridge(spark, d).join(s.truth(spark, d), ["gers_id", "local_id"]).select(F.concat(F.lit("d"), F.col("k") % 3).alias("ds"), "label")
    return x.rollup("ds").agg(F.when(F.grouping("ds") == 1, "all").otherwise(F.first("ds")).alias("slice"), F.count("*").alias("n"), F.count_if(F.col("label") == "match").alias("positives")).drop("ds")


@query("q304_upsert", W("SELECT gers_id, local_id, label FROM truth t WHERE NOT EXISTS (SELECT 1 FROM bridge b WHERE b.local_id = t.local_id AND b.k % 10 = 0) UNION ALL SELECT gers_id, local_id, 'fresh' FROM bridge WHERE k % 10 = 0"))
def upsert(spark, d):
    fresh = s.bridge(spark, d).filter("k % 10 = 0").select("gers_id", "local_id", F.lit("fresh").alias("label"))
    return lb.upsert(s.truth(spark, d), fresh, "gers_id", "local_id")


GROUPS = "og AS (SELECT k % 30 AS group_id, local_id AS edge FROM bridge WHERE k % 2 = 0), ng AS (SELECT k % 40 AS group_id, local_id AS edge FROM bridge)"


@query("q307_relabel_plan", W("SELECT old_group, new_group, shared, CASE WHEN o = 1 AND i = 1 THEN 'move' WHEN i = 1 THEN 'split' WHEN o = 1 THEN 'merge' ELSE 'tangled' END AS kind FROM (SELECT og.group_id AS old_group, ng.group_id AS new_group, count(*) AS shared, count(*) OVER (PARTITION BY og.group_id) AS o, count(*) OVER (PARTITION BY ng.group_id) AS i FROM og JOIN ng USING (edge) GROUP BY 1, 2)", GROUPS))
def relabel_plan(spark, d):
    b = s.bridge(spark, d)
    old = b.filter("k % 2 = 0").select((F.col("k") % 30).alias("group_id"), F.col("local_id").alias("edge"))
    return lb.relabel_plan(old, b.select((F.col("k") % 40).alias("group_id"), F.col("local_id").alias("edge")))


@query("q092_label_group_overlap", W("SELECT old_group, new_group, shared FROM (SELECT og.group_id AS old_group, ng.group_id AS new_group, count(*) AS shared FROM og JOIN ng USING (edge) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY old_group ORDER BY shared DESC, new_group) = 1", GROUPS))
def label_group_overlap(spark, d):
    return relabel_plan(spark, d).groupBy("old_group").agg(F.max(F.struct("shared", (-F.col("new_group")).alias("g"))).alias("m")).select("old_group", (-F.col("m.g")).alias("new_group"), F.col("m.shared").alias("shared"))


@query("q308_prior_coverage", W("SELECT group_id, count(*) FILTER (lab) = count(*) AS covered FROM (SELECT k % 40 AS group_id, local_id IN (SELECT local_id FROM truth) AS lab FROM bridge) GROUP BY 1"))
def prior_coverage(spark, d):
    b = s.bridge(spark, d).join(s.truth(spark, d).select("local_id", F.lit(1).alias("lab")), "local_id", "left")
    return b.groupBy((F.col("k") % 40).alias("group_id")).agg((F.count("lab") == F.count("*")).alias("covered"))


@query("q309_group_to_pairs", W("SELECT e AS local_id, count(*) AS n FROM (SELECT unnest(es) AS e FROM (SELECT k % 40, list(local_id) AS es FROM bridge GROUP BY 1)) WHERE e NOT IN (SELECT local_id FROM truth) GROUP BY 1"))
def group_to_pairs(spark, d):
    gr = s.bridge(spark, d).groupBy((F.col("k") % 40).alias("g")).agg(F.collect_list("local_id").alias("es"))
    return gr.select(F.explode("es").alias("local_id")).join(s.truth(spark, d), "local_id", "left_anti").groupBy("local_id").agg(F.count("*").alias("n"))


@query("q315_license_gate", "SELECT n_name, CASE WHEN n_regionkey = 0 THEN 'blocked' WHEN n_regionkey = 1 THEN 'pending' ELSE 'approved' END AS decision FROM nation")
def license_gate(spark, d):
    dim = spark.createDataFrame([(0, "blocked"), (1, "pending")], "n_regionkey int, decision string")
    return s.table(spark, d, "nation").join(F.broadcast(dim), "n_regionkey", "left").select("n_name", F.coalesce("decision", F.lit("approved")).alias("decision"))


@query("q300_expected_f1_subset")
def expected_f1_subset(spark, d):
    rows = s.bridge(spark, d).select((F.col("k") % 40).alias("g"), F.col("local_id").alias("edge"), "confidence")
    return lb.expected_f1_subset(rows, "g", "confidence")


@query("q145_batch_tiers", W("SELECT local_id, CASE WHEN contested >= 0.8 THEN 'tier1' WHEN contested >= 0.5 THEN 'tier2' ELSE 'tier3' END AS tier FROM (SELECT local_id, round(1 - abs(2 * confidence - 1), 6) AS contested FROM bridge)"))
def batch_tiers(spark, d):
    c = F.round(1 - F.abs(2 * F.col("confidence") - 1), 6)
    return s.bridge(spark, d).select("local_id", F.when(c >= 0.8, "tier1").when(c >= 0.5, "tier2").otherwise("tier3").alias("tier"))


@query("q316_gate_metrics", W("SELECT ds, p < 0.5 AS failed FROM (SELECT 'd' || (k % 3) AS ds, avg(CASE WHEN decision = 'match' THEN 1.0 ELSE 0.0 END) AS p FROM decided GROUP BY 1)"))
def gate_metrics(spark, d):
    return s.bridge(spark, d).groupBy(F.concat(F.lit("d"), F.col("k") % 3).alias("ds")).agg((F.avg((F.col("decision") == "match").cast("double")) < 0.5).alias("failed"))
