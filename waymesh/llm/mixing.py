"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

The leaves of a domain-language-source tree hold documents. A token budget is passed down from the
root: at each node, children share the parent's budget by weight, none beyond its capacity (the
tokens of its leaves times max_epochs). What a child can't take goes to its siblings by weight; as
a node's capacity is the sum of its leaves', a shortage leaves a subtree only when all of it is
exhausted. The share level is found in closed form: with children sorted by capacity / weight, those
that fill up come first.

A leaf's budget is spent in epochs: whole passes first, then a prefix, by tokens, of the leaf's
documents in the order of a hash seeded with the epoch. The prefix ends before the first document
that would exceed the budget. It is found without sorting a leaf in one task: tokens are summed in
4096 hash ranges, and only the range in which the budget ends is sorted.

Defined cases: null text has one token (as every text has at least one), so that it can be drawn;
null domain, language or source is a node named `und`; siblings without positive weight get
nothing; siblings of equal capacity per weight are taken by name; documents with equal ids have equal
order and are drawn together; an empty table gives an empty result; extra columns pass through, but for
those with the name of an added column (domain, language, mix_tokens, epoch), which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEVELS = ("domain", "language", "source")
DOMAIN_WEIGHTS = {"d0": 5, "d1": 3, "d2": 2}
LANGUAGE_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
RANGES, KEY_BITS = 4096, 48


def tokens_of(text: Column) -> Column:
    """A token estimate: a quarter of the bytes, rounded up, one at least."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4)).cast("long")


def domain_of(source: Column) -> Column:
    """A document's domain: one of three, by the source's name."""
    return F.concat(F.lit("d"), F.conv(F.substring(F.md5(F.coalesce(source, F.lit("und")).cast("binary")), 1, 4), 16, 10).cast("int") % 3)


def order_key(doc_id: Column, epoch: Column, seed: int) -> Column:
    """The place of a document in an epoch, as a 48-bit number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def weight_of(name: Column, weights: dict[str, int], other: int) -> Column:
    out = F.lit(None).cast("double")
    for k, v in weights.items():
        out = F.coalesce(out, F.when(name == k, F.lit(float(v))))
    return F.coalesce(out, F.lit(float(other)))


def share_out(nodes: DataFrame, parents: list[str], budget: str, weight: str, capacity: str, name: str) -> DataFrame:
    """nodes with `budget` split among the children of each parent: column `share`."""
    w = F.greatest(F.col(weight), F.lit(0.0))
    ratio = F.when(w > 0, F.col(capacity) / w).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parents).orderBy("__ratio", name)
    whole = Window.partitionBy(*parents)
    before = F.coalesce(F.sum(capacity).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("__w").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = (F.col("__w") > 0) & (F.col("__before") + F.col("__ratio") * F.col("__after") <= F.col(budget))
    out = nodes.withColumns({"__w": w, "__ratio": ratio}).withColumns({"__before": before, "__after": after}).withColumn("__full", full)
    rest = F.col(budget) - F.coalesce(F.sum(F.when(F.col("__full"), F.col(capacity))).over(whole), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("__full"), F.col("__w"))).over(whole)
    level = F.when(open_weight > 0, F.greatest(rest, F.lit(0.0)) / open_weight).otherwise(0.0)
    share = F.when(F.col("__full"), F.col(capacity)).otherwise(F.least(F.col("__w") * level, F.col(capacity)))
    return out.withColumn("share", share).drop("__w", "__ratio", "__before", "__after", "__full")


def leaf_budgets(leaves: DataFrame, fraction: float, max_epochs: int, domain_weights: dict = DOMAIN_WEIGHTS, language_weights: dict = LANGUAGE_WEIGHTS, source_weights: dict | None = None) -> DataFrame:
    """leaves (LEVELS, tokens; one row a leaf) with capacity and budget, in tokens.

    Each level reads the leaves once and joins its parents' shares, so the plan grows by the level and
    not by its square. Only the total, one number, comes to the driver.
    """
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    out = leaves.withColumn("capacity", F.col("tokens").cast("double") * max_epochs)
    shares: DataFrame | None = None
    above: list[str] = []
    for level, weights in zip(LEVELS, (domain_weights, language_weights, source_weights or {}), strict=True):
        path = [*above, level]
        nodes = out.groupBy(*path).agg(F.sum("capacity").alias("node_capacity")) if level != LEVELS[-1] else out.withColumnRenamed("capacity", "node_capacity")
        nodes = nodes.withColumn("weight", weight_of(F.col(level), weights, 1))
        if shares is None:
            nodes = nodes.withColumns({"__root": F.lit(0), "parent_budget": F.floor(F.lit(total) * F.lit(fraction)).cast("double")})
        else:
            nodes = nodes.join(shares, above)
        shared = share_out(nodes, above or ["__root"], "parent_budget", "weight", "node_capacity", level)
        shares = shared.select(*path, F.col("share").alias("parent_budget"))
        above = path
    final = shared.select(*LEVELS, "tokens", F.col("node_capacity").alias("capacity"), F.floor(F.col("share") + 1e-6).cast("long").alias("budget"))
    return final


def mix(
    docs: DataFrame, fraction: float = 0.5, max_epochs: int = 2, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", most_broadcast: int = 100_000, **weights
) -> DataFrame:
    """The drawn documents, with domain, language, mix_tokens and epoch added; a document drawn in two epochs stands twice."""
    leaf = {
        "__wm_domain": F.coalesce(domain_of(F.col(source_col)), F.lit("und")),
        "__wm_language": F.coalesce(F.col(lang_col), F.lit("und")),
        "__wm_source": F.coalesce(F.col(source_col), F.lit("und")),
        "__wm_tokens": tokens_of(F.col(text_col)),
    }
    keys = ["__wm_domain", "__wm_language", "__wm_source"]
    tagged = docs.withColumns(leaf)
    meta = written(tagged.select(F.col(id_col).alias("id"), F.col(keys[0]).alias("domain"), F.col(keys[1]).alias("language"), F.col(keys[2]).alias("source"), F.col("__wm_tokens").alias("n")))
    leaves = written(meta.groupBy(*LEVELS).agg(F.sum("n").alias("tokens")))
    budgets = leaf_budgets(leaves, fraction, max_epochs, **weights)
    budgets = budgets.withColumn("whole", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
    budgets = written(budgets.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")))
    few = budgets.limit(most_broadcast + 1).count() <= most_broadcast
    small = F.broadcast if few else (lambda x: x)
    key = order_key(F.col("id"), F.col("whole"), seed)
    placed = meta.join(small(budgets.select(*LEVELS, "whole", "rest")), list(LEVELS)).withColumn("key", key).withColumn("range", F.shiftright("key", KEY_BITS - 12))
    sums = placed.groupBy(*LEVELS, "range").agg(F.sum("n").alias("n"), F.first("rest").alias("rest"))
    over = Window.partitionBy(*LEVELS).orderBy("range")
    sums = sums.withColumn("upto", F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, 0)))
    last = sums.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
    last = written(last.groupBy(*LEVELS).agg(F.min("range").alias("range"), F.min(F.col("upto") - F.col("n")).alias("before")))
    inside = placed.join(small(last), [*LEVELS, "range"])
    run = Window.partitionBy(*LEVELS, "range").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    ends = inside.withColumn("upto", F.sum("n").over(run) + F.col("before")).filter(F.col("upto") <= F.col("rest"))
    ends = ends.groupBy(*LEVELS).agg(F.max("key").alias("end"))
    # a leaf whose budget ends inside a range is drawn up to `end`, or up to the range if nothing fits
    plan = budgets.join(last, list(LEVELS), "left").join(ends, list(LEVELS), "left")
    start = F.shiftleft(F.col("range").cast("long"), KEY_BITS - 12) - 1
    plan = plan.select(*LEVELS, "whole", F.when(F.col("rest") <= 0, F.lit(-1)).otherwise(F.coalesce("end", start, F.lit(-1))).cast("long").alias("end"))
    plan = written(plan).toDF(*keys, "__wm_whole", "__wm_end")
    drawn = tagged.join(small(plan), keys)
    partial = order_key(F.col(id_col), F.col("__wm_whole"), seed) <= F.col("__wm_end")
    passes = F.col("__wm_whole") + F.when(partial, 1).otherwise(0)
    drawn = drawn.withColumn("__wm_passes", passes).filter("__wm_passes > 0").withColumn("__wm_epoch", F.explode(F.sequence(F.lit(0), F.col("__wm_passes") - 1)))
    return drawn.select(*[f"`{c}`" for c in docs.columns if c not in ("domain", "language", "mix_tokens", "epoch")], F.col(keys[0]).alias("domain"), F.col(keys[1]).alias("language"), F.col("__wm_tokens").alias("mix_tokens"), F.col("__wm_epoch").alias("epoch"))


def oracle(source: str = "documents", fraction: float = 0.5, max_epochs: int = 2, seed: int = 7, columns: str = "doc_id, domain, language, coalesce(source, 'und') AS source, n AS mix_tokens, epoch") -> str:
    """The same draw as DuckDB SQL: windows over whole leaves."""

    def share(level: str, path: str, table: str, parent: str, weights: dict) -> str:
        case = "CASE " + level + " " + " ".join(f"WHEN '{k}' THEN {v}.0" for k, v in weights.items()) + " ELSE 1.0 END" if weights else "1.0"
        keys = f"{parent}, {level}" if parent else level
        part = f"PARTITION BY {parent}" if parent else ""
        return f"""
{path}0 AS (SELECT {keys}, sum(capacity)::DOUBLE AS c, any_value(budget)::DOUBLE AS b, ({case})::DOUBLE AS w FROM {table} GROUP BY {keys}),
{path}1 AS (SELECT *, c / w AS ratio FROM {path}0),
{path}2 AS (SELECT *, coalesce(sum(c) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + ratio * sum(w) OVER ({part} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= b AS filled FROM {path}1),
{path}3 AS (SELECT *, b - coalesce(sum(CASE WHEN filled THEN c END) OVER ({part}), 0) AS left_over, sum(CASE WHEN NOT filled THEN w END) OVER ({part}) AS open_w FROM {path}2),
{path} AS (SELECT t.* EXCLUDE (budget), CASE WHEN filled THEN c ELSE least(w * CASE WHEN open_w > 0 THEN greatest(left_over, 0) / open_w ELSE 0 END, c) END AS budget FROM {table} t JOIN {path}3 USING ({keys}))"""

    number = "('0x' || substr(md5({}), 1, {}))::BIGINT"
    domain = f"'d' || ({number.format(chr(99) + 'oalesce(source, ' + chr(39) + 'und' + chr(39) + ')', 4)} % 3)::VARCHAR"
    key = number.format(f"'{seed}:' || epoch::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')", KEY_BITS // 4)
    return f"""
WITH x AS (SELECT * EXCLUDE (source), source, {domain} AS domain, coalesce(lang, 'und') AS language, coalesce(source, 'und') AS src, greatest(1, (coalesce(strlen(text), 0) + 3) // 4)::BIGINT AS n FROM {source}),
leaves AS (SELECT domain, language, src, sum(n)::BIGINT AS tokens, sum(n)::DOUBLE * {max_epochs} AS capacity, floor((SELECT sum(n) FROM x) * {fraction}) AS budget FROM x GROUP BY ALL),{share("domain", "s1", "leaves", "", DOMAIN_WEIGHTS)},{share("language", "s2", "s1", "domain", LANGUAGE_WEIGHTS)},{share("src", "s3", "s2", "domain, language", {})},
plan AS (SELECT domain, language, src, tokens, floor(budget + 1e-6)::BIGINT AS budget, floor(floor(budget + 1e-6) / tokens)::BIGINT AS whole FROM s3),
each AS (SELECT x.*, whole, budget - whole * tokens AS rest, unnest(range(whole + 1)) AS epoch FROM x JOIN plan USING (domain, language, src)),
placed AS (SELECT *, sum(n) OVER (PARTITION BY domain, language, src, epoch ORDER BY {key}) AS upto FROM each)
SELECT {columns} FROM placed WHERE epoch < whole OR (rest > 0 AND upto <= rest)"""
