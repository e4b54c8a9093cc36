"""Scoring, assignment and grouping of candidate pairs."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import blocking


def scratch(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the folder of spark.checkpoint.dir, reread; cuts the lineage of loops.

    Joins with it are merged: Spark would judge it by the size of its compressed files and send millions of rows to the driver.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_dir(spark.sparkContext.applicationId)
    path = f"{root.rstrip('/')}/waymesh-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path).hint("merge")


@cache
def _own_dir(application: str) -> str:
    """A folder of our own where spark.checkpoint.dir is unset, as in tests."""
    return "file://" + tempfile.mkdtemp(prefix="waymesh-scratch-")


def _forget(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may have ended before; the folder is a scratch area
        return


def naive(ref: DataFrame, target: DataFrame, buffer_m: float = 15.0, min_overlap: float = 0.3, angle: float = 35.0) -> DataFrame:
    """Each reference segment's best target by overlap share times the cosine of the bearing difference."""
    pairs = blocking.box_join(blocking.with_pieces(ref.select("id", "xy")), blocking.with_pieces(target.select("id", "xy")), buffer_m)
    pairs = pairs.withColumn("bearing_diff", g.heading_delta(F.col("ref_h"), F.col("target_h"))).filter(F.col("bearing_diff") <= angle)
    pairs = blocking.overlaps(pairs, ["ref_id", "target_id", "ref_n", "bearing_diff"], buffer_m).withColumn("overlap", F.col("overlap_m") / F.nullif("ref_n", F.lit(0.0)))
    pairs = pairs.filter(F.col("overlap") >= min_overlap).withColumn("score", F.col("overlap") * F.cos(F.radians("bearing_diff")))
    best = Window.partitionBy("ref_id").orderBy(F.desc(F.round("score", 9)), "target_id")
    return pairs.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("ref_id", "target_id", "overlap", "bearing_diff", "score")


def scored(ref: DataFrame, target: DataFrame, metres: float = 25.0) -> DataFrame:
    """Candidate pairs with transparent rule confidence from overlap both ways, heading and names.

    The box join and the distances carry ids and pieces only; lines and attributes are fetched by id for pairs that are near.
    """
    short = lambda d: blocking.with_pieces(d.select("id", "xy")).select("id", "xy", "parts")
    boxes = blocking.box_join(short(ref), short(target), metres)
    near = blocking.line_distances(boxes, ["ref_id", "target_id"]).filter(F.col("distance") <= metres)
    side = lambda d, prefix: d.select(*[F.col(c).alias(prefix + c) for c in d.columns])
    pairs = near.join(side(blocking.with_pieces(ref), "ref_"), "ref_id").join(side(blocking.with_pieces(target), "target_"), "target_id")
    a, b = F.col("ref_xy"), F.col("target_xy")
    ra, rb = g.project(g.first(b), a)["f"], g.project(g.last(b), a)["f"]
    ta, tb = g.project(g.first(a), b)["f"], g.project(g.last(a), b)["f"]
    pairs = pairs.withColumns({"__ra": ra, "__rb": rb, "__ta": ta, "__tb": tb})
    pairs = pairs.withColumns(
        {
            "heading_diff": g.heading_delta(F.col("ref_h"), F.col("target_h")),
            "ref_from": F.least("__ra", "__rb"), "ref_to": F.greatest("__ra", "__rb"), "target_from": F.least("__ta", "__tb"), "target_to": F.greatest("__ta", "__tb"),
            "ref_length": F.col("ref_n"), "target_length": F.col("target_n"),
            "same_name": (F.coalesce(F.col("ref_name"), F.lit("")) != "") & (F.col("ref_name") == F.col("target_name")),
        }
    ).drop("__ra", "__rb", "__ta", "__tb").fillna({"same_name": False})
    cover = F.least(F.lit(1.0), F.greatest(F.col("ref_to") - F.col("ref_from"), F.col("target_to") - F.col("target_from")))
    near = 1 - F.col("distance") / metres
    conf = F.greatest(F.lit(0.0), F.lit(0.45) * cover + F.lit(0.3) * (1 - F.col("heading_diff") / 90) + F.lit(0.2) * near + F.when(F.col("same_name"), 0.05).otherwise(0.0))
    return pairs.withColumns({"coverage": cover, "overlap_m": (F.col("ref_to") - F.col("ref_from")) * F.col("ref_length"), "confidence": F.round(conf, 6)})


def decide(confidence: Column, match: float = 0.5, review: float = 0.1) -> Column:
    return F.when(confidence >= match, "match").when(confidence >= review, "review").otherwise("no_match")


def is_sliver(span_ref: Column, span_target: Column, overlap_ref: Column, overlap_target: Column, span: float = 0.10, metres: float = 5.0) -> Column:
    """Both the largest span and the largest overlap are tiny; what is unmeasured is never a sliver."""
    inf = F.lit(float("inf"))
    return (F.greatest(F.coalesce(span_ref, F.lit(1.0)), F.coalesce(span_target, F.lit(1.0))) < span) & (F.greatest(F.coalesce(overlap_ref, inf), F.coalesce(overlap_target, inf)) < metres)


def rank_order() -> list[Column]:
    """The canonical total order of results: confidence, same name, coverage, ids."""
    return [F.desc("confidence"), F.desc(F.col("same_name").cast("int")), F.desc(F.round("coverage", 9)), F.asc("ref_id"), F.asc("target_id")]


def greedy(pairs: DataFrame, least: float = 0.1) -> DataFrame:
    """One-to-one assignment, equal to taking pairs in the canonical order while both ends are free.

    Each round takes every pair that is first for both its ends; their ends leave. Rounds end when
    no pair is left, whose number has no bound but the pairs': the best pair of all is taken in each.
    Each is written, so that the plan stays short.
    """
    by_ref, by_target = Window.partitionBy("ref_id").orderBy(*rank_order()), Window.partitionBy("target_id").orderBy(*rank_order())
    left, taken = scratch(pairs.filter(F.col("confidence") >= least)), None
    while True:
        won = left.withColumn("__a", F.row_number().over(by_ref)).withColumn("__b", F.row_number().over(by_target)).filter("__a = 1 AND __b = 1").drop("__a", "__b")
        won = scratch(won)
        taken = won if taken is None else taken.unionByName(won)
        left = scratch(left.join(won.select("ref_id"), "ref_id", "left_anti").join(won.select("target_id"), "target_id", "left_anti").select(pairs.columns))
        if left.isEmpty():
            return taken


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node, component (least node of each connected component) of edges (u, v), by alternating stars."""
    now, mark = scratch(edges.filter("u <> v").select("u", "v").distinct()), None
    nodes = edges.select(F.col("u").alias("node")).unionAll(edges.select(F.col("v").alias("node"))).distinct()
    for _ in range(most_rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(hub, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        nxt = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        now = scratch(nxt.filter("u <> v").distinct())
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark:
            return nodes.join(now, nodes["node"] == now["u"], "left").select("node", F.coalesce("v", "node").alias("component"))
        mark = seen
    raise RuntimeError("components did not settle")


def match_components(pairs: DataFrame, least: float = 0.1, glue: float = 0.5) -> DataFrame:
    """pairs with component: structural edges form components, weak or sliver edges join only inside one."""
    span_r, span_t = F.col("ref_to") - F.col("ref_from"), F.col("target_to") - F.col("target_from")
    thin = is_sliver(span_r, span_t, span_r * F.col("ref_length"), span_t * F.col("target_length"))
    kept = scratch(pairs.filter(F.col("confidence") >= least).withColumn("structural", (F.col("confidence") >= glue) & ~thin))
    strong = kept.filter("structural").select(F.concat(F.lit("r:"), "ref_id").alias("u"), F.concat(F.lit("t:"), "target_id").alias("v"))
    named = scratch(components(strong))
    r = named.select(F.col("node").alias("__r"), F.col("component").alias("__rc"))
    t = named.select(F.col("node").alias("__t"), F.col("component").alias("__tc"))
    out = kept.join(r, F.concat(F.lit("r:"), "ref_id") == F.col("__r")).join(t, F.concat(F.lit("t:"), "target_id") == F.col("__t"))
    return out.filter("__rc = __tc").withColumnRenamed("__rc", "component").drop("__r", "__t", "__tc")


def match_type(refs: Column, targets: Column) -> Column:
    return F.when((refs == 1) & (targets == 1), "1:1").when(refs == 1, "1:N").when(targets == 1, "N:1").otherwise("M:N")


def group_hash(refs: Column, targets: Column) -> Column:
    """Eight hex digits of a group's sorted members."""
    return F.substring(F.sha2(F.concat(F.array_join(F.array_sort(refs), "|"), F.lit("||"), F.array_join(F.array_sort(targets), "|")), 256), 1, 8)


def groups(in_components: DataFrame, match_at: float = 0.5) -> DataFrame:
    """One row per component: members, cardinality, decision by average confidence, group id."""
    g1 = in_components.groupBy("component").agg(
        F.array_sort(F.collect_set("ref_id")).alias("ref_ids"), F.array_sort(F.collect_set("target_id")).alias("target_ids"), F.avg("confidence").alias("avg_confidence"), F.count("*").alias("n_edges")
    )
    return g1.select(
        "component", group_hash(F.col("ref_ids"), F.col("target_ids")).alias("group_id"), "ref_ids", "target_ids", "n_edges", "avg_confidence",
        match_type(F.size("ref_ids"), F.size("target_ids")).alias("match_type"), F.when(F.col("avg_confidence") >= match_at, "match").otherwise("review").alias("decision"),
    )


def prune(in_components: DataFrame, floor: float = 0.6, sure: float = 0.75) -> DataFrame:
    """Group edges under the floor go, but for the group's best; a lone survivor below `sure` is for review."""
    w = Window.partitionBy("component").orderBy(*rank_order())
    kept = in_components.withColumn("__rank", F.row_number().over(w)).filter((F.col("confidence") >= floor) | (F.col("__rank") == 1))
    n = F.count("*").over(Window.partitionBy("component"))
    return kept.withColumn("decision", F.when((n == 1) & (F.col("confidence") < sure), "review").otherwise(decide(F.col("confidence")))).drop("__rank")


def propagate(pairs: DataFrame, cell: float = 25.0, rounds: int = 2, damping: float = 0.5, cap: float = 1.5) -> DataFrame:
    """Two rounds of damped messages: pairs whose both sides have an end in the same grid corner agree, pairs that share a side compete."""
    base = pairs.select("ref_id", "target_id", "confidence", "ref_xy", "target_xy").withColumn("pair", F.concat_ws("|", "ref_id", "target_id"))
    p = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("confidence")))
    base = scratch(base.withColumn("logit", F.log(p / (1 - p))))

    def corners(side: str) -> Column:
        return F.array_distinct(F.transform(F.array(g.first(F.col(side)), g.last(F.col(side))), lambda q: F.struct(g.snap_cell(q["x"], cell).alias("cx"), g.snap_cell(q["y"], cell).alias("cy"))))

    def best_other(side: str) -> Column:
        """The greatest p among the other pairs of the same segment: the second for the first pair, else the first."""
        w = Window.partitionBy(side).orderBy(F.desc("p"), "pair")
        return F.when(F.row_number().over(w) == 1, F.lead("p").over(w)).otherwise(F.first("p").over(w))

    ends = base.select("pair", "ref_id", "target_id", F.explode(F.array_intersect(corners("ref_xy"), corners("target_xy"))).alias("corner"))
    other = ends.select(F.col("pair").alias("q"), F.col("ref_id").alias("q_ref"), F.col("target_id").alias("q_target"), "corner")
    agree = scratch(ends.join(other, "corner").filter((F.col("ref_id") != F.col("q_ref")) & (F.col("target_id") != F.col("q_target"))).select("pair", "q").distinct())
    drift = base.select("pair", "ref_id", "target_id", "logit", F.lit(0.0).alias("drift"))
    for _ in range(rounds):
        now = drift.withColumn("p", 1 / (1 + F.exp(-(F.col("logit") + F.col("drift")))))
        up = agree.join(now.select(F.col("pair").alias("q"), "p"), "q").groupBy("pair").agg(F.avg("p").alias("up"))
        down = now.withColumns({"by_ref": best_other("ref_id"), "by_target": best_other("target_id")}).withColumn("down", F.greatest("by_ref", "by_target"))
        push = F.coalesce(F.col("up"), F.lit(0.0)) * 0.6 - F.coalesce(F.col("down"), F.lit(0.0)) * 0.6
        moved = down.join(up, "pair", "left").withColumn("drift", F.greatest(F.lit(-cap), F.least(F.lit(cap), damping * F.col("drift") + (1 - damping) * push)))
        drift = scratch(moved.select("pair", "ref_id", "target_id", "logit", "drift"))
    return base.join(drift.select("pair", "drift"), "pair").select("ref_id", "target_id", "confidence", (1 / (1 + F.exp(-(F.col("logit") + F.col("drift"))))).alias("propagated"))


def bridge(pairs: DataFrame, least: float = 0.1) -> DataFrame:
    """The bridge table: greedy one-to-one results with decision and both fraction ranges."""
    won = greedy(pairs, least)
    return won.select(
        F.col("target_id").alias("local_id"), F.col("ref_id").alias("gers_id"), "confidence", F.lit("1:1").alias("match_type"), F.lit("rule").alias("match_method"),
        decide(F.col("confidence"), 0.75, 0.5).alias("match_decision"), F.col("ref_from").alias("gers_start_frac"), F.col("ref_to").alias("gers_end_frac"),
        F.col("target_from").alias("local_start_frac"), F.col("target_to").alias("local_end_frac"),
    )
