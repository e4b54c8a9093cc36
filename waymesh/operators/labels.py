"""Label stores, votes, consensus and rule expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def class_by_rules(rules: list[tuple[str, str, str, str]], default: str) -> Column:
    """First rule (column, operator, value, class) that holds; ordering operators compare as numbers, a null fails."""
    out = None
    for column, op, value, name in rules:
        c, v = F.col(column), float(value) if op in (">", ">=", "<", "<=") else value
        n = c.try_cast("double")
        test = {">": lambda: n > v, ">=": lambda: n >= v, "<": lambda: n < v, "<=": lambda: n <= v}.get(op, lambda: c.cast("string") == v)()
        test = F.coalesce(test, F.lit(False))
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.lit(default) if out is None else out.otherwise(default)


def interpolated(x: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """Piecewise linear value through knots, clamped at the ends."""
    out = F.when(x <= knots[0][0], knots[0][1])
    for (x0, y0), (x1, y1) in zip(knots, knots[1:], strict=False):
        out = out.when(x <= x1, y0 + (x - x0) / (x1 - x0) * (y1 - y0))
    return out.otherwise(knots[-1][1])


def latest(votes: DataFrame, *keys: str) -> DataFrame:
    """The newest vote of each key; later ids win equal times."""
    rest = [c for c in votes.columns if c not in keys and c not in ("ts", "vote_id")]
    return votes.groupBy(*keys).agg(F.max(F.struct("ts", "vote_id", *rest)).alias("m")).select(*keys, "m.*")


def consensus(ballots: DataFrame, abstain: str = "ABSTAIN") -> DataFrame:
    """group_id, n_valid, top, choice, tier, mean_confidence, minority over one ballot per seat.

    All valid votes alike and at least three: unanimous without abstention, else quorum; otherwise two
    or more for the top choice: majority; else none. mean_confidence is of the winning votes.
    """
    valid = ballots.filter(F.col("choice") != abstain)
    per = valid.groupBy("group_id", "choice").agg(F.count("*").alias("n"), F.avg("conf").alias("c"))
    w = Window.partitionBy("group_id").orderBy(F.desc("n"), "choice")
    ranked = per.withColumns({"rn": F.row_number().over(w), "n_valid": F.sum("n").over(Window.partitionBy("group_id"))})
    out = ranked.groupBy("group_id").agg(
        F.max("n_valid").alias("n_valid"), F.max(F.when(F.col("rn") == 1, F.col("n"))).alias("top"), F.max(F.when(F.col("rn") == 1, F.col("choice"))).alias("choice"),
        F.max(F.when(F.col("rn") == 1, F.round(F.col("c") + 1e-9, 3))).alias("mean_confidence"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("rn") > 1, F.col("choice")))), ",").alias("minority"),
    )
    cast = ballots.groupBy("group_id").agg(F.count_if(F.col("choice") == abstain).alias("abstained"))
    whole = (F.col("top") == F.col("n_valid")) & (F.col("n_valid") >= 3)
    tier = F.when(whole & (F.col("abstained") == 0), "unanimous").when(whole, "quorum").when(F.col("top") >= 2, "majority").otherwise("none")
    return out.join(cast, "group_id").withColumn("tier", tier).drop("abstained")


def upsert(store: DataFrame, fresh: DataFrame, *keys: str) -> DataFrame:
    """Stored rows whose keys aren't in fresh, and all fresh rows."""
    return store.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def quarantine(labels: DataFrame, *keys: str) -> DataFrame:
    """keys, label, n, quarantined: keys with disagreeing labels are quarantined, agreeing repeats collapse."""
    return labels.groupBy(*keys).agg(F.min("label").alias("label"), F.count("*").alias("n"), (F.count_distinct("label") > 1).alias("quarantined"))


def relabel_plan(old: DataFrame, new: DataFrame) -> DataFrame:
    """old_group, new_group, shared, kind of old groups (group_id, edge) against new ones: move, split, merge or tangled."""
    o, n = old.select(F.col("group_id").alias("old_group"), "edge"), new.select(F.col("group_id").alias("new_group"), "edge")
    both = o.join(n, "edge").groupBy("old_group", "new_group").agg(F.count("*").alias("shared"))
    outs, ins = F.count("*").over(Window.partitionBy("old_group")), F.count("*").over(Window.partitionBy("new_group"))
    return both.withColumn("kind", F.when((outs == 1) & (ins == 1), "move").when(ins == 1, "split").when(outs == 1, "merge").otherwise("tangled"))


def expected_f1_subset(rows: DataFrame, group: str, p: str, empty_bonus: float = 0.0) -> DataFrame:
    """group, k, value: the number of most probable edges that maximises expected F1; k = 0 scores the chance that all are wrong."""
    w = Window.partitionBy(group).orderBy(F.desc(p), "edge")
    whole = F.sum(p).over(Window.partitionBy(group))
    run = rows.withColumns({"k": F.row_number().over(w), "upto": F.sum(p).over(w.rowsBetween(Window.unboundedPreceding, 0)), "whole": whole})
    scored = run.select(group, "k", (2 * F.col("upto") / (F.col("k") + F.col("whole"))).alias("value"))
    none = rows.groupBy(group).agg((F.exp(F.sum(F.log(F.greatest(1 - F.col(p), F.lit(1e-12))))) + empty_bonus).alias("value")).select(group, F.lit(0).alias("k"), "value")
    best = scored.unionByName(none).groupBy(group).agg(F.max(F.struct(F.round("value", 9).alias("value"), (-F.col("k")).alias("k"))).alias("m"))
    return best.select(group, (-F.col("m.k")).alias("k"), F.col("m.value").alias("value"))
