"""Bridge tables: sinks, merges, churn, profiles and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def unmatched(target: DataFrame, bridge: DataFrame) -> DataFrame:
    """Target rows that no match claims, with the reason."""
    review = bridge.filter("decision = 'review'").select(F.col("local_id").alias("id")).distinct().withColumn("__r", F.lit(True))
    left = target.join(bridge.filter("decision = 'match'").select(F.col("local_id").alias("id")), "id", "left_anti").join(review, "id", "left")
    return left.withColumn("unmatched_reason", F.when(F.col("__r"), "low_confidence_review").otherwise("no_match_found")).drop("__r").withColumnRenamed("id", "local_id")


def with_sides(bridge: DataFrame, ref: DataFrame, target: DataFrame) -> DataFrame:
    r = ref.select(F.col("id").alias("gers_id"), F.col("class").alias("ref_class"), F.col("name").alias("ref_name"))
    t = target.select(F.col("id").alias("local_id"), F.col("class").alias("target_class"), F.col("name").alias("target_name"))
    return bridge.join(r, "gers_id").join(t, "local_id")


def merged(tables: list[DataFrame], strategy: str = "highest_confidence") -> DataFrame:
    """Union of bridges: all rows, the first table's row, or the most confident row of each local id."""
    rows = None
    for i, t in enumerate(tables):
        t = t.withColumn("__source", F.lit(i))
        rows = t if rows is None else rows.unionByName(t)
    if strategy == "all":
        return rows.drop("__source")
    order = ["__source", "gers_id"] if strategy == "first" else [F.desc("confidence"), "gers_id"]
    w = Window.partitionBy("local_id").orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", "__source")


def unified(tables: dict[str, DataFrame]) -> DataFrame:
    """One long table in ranges of gers_id, sorted within, so that lookups by id prune row groups."""
    rows = None
    for name, t in tables.items():
        t = t.withColumn("dataset", F.lit(name))
        rows = t if rows is None else rows.unionByName(t)
    return rows.repartitionByRange("gers_id").sortWithinPartitions("gers_id", "dataset", "local_id")


def churn(old: DataFrame, new: DataFrame) -> DataFrame:
    """local_id, category (same, changed, lost, gained), from_gers, to_gers."""
    sets = lambda t, c: t.groupBy("local_id").agg(F.array_join(F.array_sort(F.collect_set("gers_id")), ";").alias(c))
    both = sets(old, "a").join(sets(new, "b"), "local_id", "full")
    category = F.when(F.col("a").isNull(), "gained").when(F.col("b").isNull(), "lost").when(F.col("a") == F.col("b"), "same").otherwise("changed")
    return both.select("local_id", category.alias("category"), F.coalesce("a", F.lit("")).alias("from_gers"), F.coalesce("b", F.lit("")).alias("to_gers"))


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row of quality figures of a segment table."""
    n = rows.select("name", "class", g.length(F.col("xy")).alias("m"))
    return n.agg(
        F.count("*").alias("n"), F.round(F.sum("m"), 3).alias("total_m"), F.round(F.avg((F.trim(F.coalesce("name", F.lit(""))) != "").cast("double")), 6).alias("name_coverage"),
        F.count_distinct("class").alias("n_classes"), F.round(F.percentile("m", 0.5), 6).alias("median_m"),
    )


def compare_fingerprints(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both are one-row tables. Fails on a name coverage 0.3 lower or a count off by half."""
    x, y = a.select(F.col("n").alias("n_a"), F.col("name_coverage").alias("c_a"), F.lit(0).alias("i")), b.select(F.col("n").alias("n_b"), F.col("name_coverage").alias("c_b"), F.lit(0).alias("i"))
    change = F.col("c_b") - F.col("c_a")
    return x.join(y, "i").select("n_a", "n_b", F.round(change, 6).alias("coverage_change"), ((change < -0.3) | (F.abs(F.col("n_b") - F.col("n_a")) > 0.5 * F.col("n_a"))).alias("failed"))


def profile(rows: DataFrame, top: int = 20) -> DataFrame:
    """col, value, n: the most frequent values of every column."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in rows.columns])).alias("x")).select("x.*")
    w = Window.partitionBy("col").orderBy(F.desc("n"), "value")
    return long.groupBy("col", "value").agg(F.count("*").alias("n")).withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= top).drop("__rn")


def prf(predicted: DataFrame, truth: DataFrame, *by: str) -> DataFrame:
    """tp, fp, fn, p, r, f1 of predicted pairs against labelled ones."""
    said = predicted.select("gers_id", "local_id").distinct().withColumn("said", F.lit(True))
    both = truth.join(said, ["gers_id", "local_id"], "left").withColumn("said", F.coalesce("said", F.lit(False)))
    n = both.groupBy(*by).agg(
        F.count_if(F.col("said") & (F.col("label") == "match")).alias("tp"), F.count_if(F.col("said") & (F.col("label") == "no_match")).alias("fp"), F.count_if(~F.col("said") & (F.col("label") == "match")).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratio = lambda a, b: F.round(F.try_divide(a, b), 6)
    return n.select(*by, "tp", "fp", "fn", ratio(tp, tp + fp).alias("p"), ratio(tp, tp + fn).alias("r"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def blocking_recall(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """labelled, retained, recall of labelled matches among candidates."""
    hit = candidates.select("gers_id", "local_id").distinct().withColumn("kept", F.lit(True))
    t = truth.filter("label = 'match'").join(hit, ["gers_id", "local_id"], "left")
    n = t.agg(F.count("*").alias("labelled"), F.count("kept").alias("retained"))
    return n.withColumn("recall", F.round(F.try_divide("retained", "labelled"), 6))


def calibration_error(rows: DataFrame, bins: int = 10) -> DataFrame:
    """ece and brier of rows (p, y)."""
    b = rows.groupBy(F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"), F.avg("p").alias("p"), F.avg("y").alias("y"), F.sum((F.col("p") - F.col("y")) ** 2).alias("b"))
    return b.agg(F.round(F.sum(F.abs(F.col("p") - F.col("y")) * F.col("n")) / F.sum("n"), 6).alias("ece"), F.round(F.sum("b") / F.sum("n"), 6).alias("brier"))


def bootstrap(rows: DataFrame, group: str, value: str, rounds: int) -> DataFrame:
    """low and high of a 95 % interval of the mean, resampling groups by hashed Poisson weights.

    Each group is pre-aggregated once; its weight in a round comes from a hash, so that lost tasks repeat alike.
    """
    sums = rows.groupBy(group).agg(F.sum(value).alias("s"), F.count("*").alias("n"))
    u = F.pmod(F.xxhash64(group, "round"), F.lit(1_000_000)) / 1e6
    weight = F.lit(0)
    upto, term = 0.0, 0.36787944117144233
    for k in range(8):
        upto += term
        weight = weight + F.when(u > upto, 1).otherwise(0)
        term /= k + 1
    drawn = sums.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("w", weight)
    means = drawn.groupBy("round").agg((F.sum(F.col("w") * F.col("s")) / F.sum(F.col("w") * F.col("n"))).alias("m"))
    return means.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))


def stratified(rows: DataFrame, bucket: Column, key: str, quota: int, seed: int = 7) -> DataFrame:
    """At most `quota` rows of each bucket, in the order of a seeded hash of the key."""
    w = Window.partitionBy("bucket").orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
    return rows.withColumn("bucket", bucket).withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= quota).drop("__rn")
