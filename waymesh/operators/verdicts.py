"""Rules on labels and verdicts: routing reasons, recombined sub-problems, set labels, decision stacks, model choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reason codes of a consensus row's route.
UNANIMOUS, UNANIMOUS_NONE, QUORUM, QUORUM_NONE = "unanimous", "unanimous_none", "quorum", "quorum_none"
NO_MAJORITY, ALL_ABSTAINED, ABSTENTION, CLASS_MISMATCH = "no_majority", "all_abstained", "abstention", "class-mismatch"
DISSENT, BELOW_QUORUM = "dissent:", "below_quorum:"


def route_reason(routing: Column, consensus: Column, choice: Column, minority: Column, n_valid: Column, n_votes: Column, stamped: Column) -> Column:
    """Reason code of a consensus row: its own stamp where that tells something, else what its counts say; empty if nothing does."""
    told = F.when(stamped == "unanimous_NONE", UNANIMOUS_NONE).when((F.trim(stamped) != "") & ~stamped.isin("majority", "none"), stamped)
    accepted = F.when((consensus == "quorum") | ~F.coalesce(n_valid == n_votes, F.lit(True)), QUORUM).otherwise(UNANIMOUS)
    agreed = F.when(choice == "NONE", F.when(consensus == "quorum", QUORUM_NONE).otherwise(UNANIMOUS_NONE)).otherwise(CLASS_MISMATCH)
    dissent = F.concat(F.lit(DISSENT), F.regexp_replace(F.regexp_replace(minority, "; ", ","), " ", ""))
    few = F.concat(F.lit(BELOW_QUORUM), F.coalesce(n_valid.cast("string"), F.lit("?")))
    majority = F.when(F.coalesce(minority, F.lit("")) != "", dissent).when(n_valid >= 3, ABSTENTION).otherwise(few)
    none = F.when((n_valid == 0) | (minority == "all providers abstained"), ALL_ABSTAINED).otherwise(NO_MAJORITY)
    derived = (
        F.when(routing == "auto_accept", accepted).when(consensus.isin("unanimous", "quorum"), agreed)
        .when(consensus == "majority", majority).when(consensus == "none", none).otherwise("")
    )
    return F.coalesce(told, derived)


def recomposed(roster: DataFrame, verdicts: DataFrame) -> DataFrame:
    """parent, status, n_subproblems, n_resolved, union_edges from a roster (parent, sub) and verdicts (sub, routing, edges).

    A group is complete only if every sub-problem of the roster is accepted; a refusal outweighs a
    missing verdict; verdicts outside the roster count for nothing.
    """
    j = roster.select("parent", "sub").distinct().join(verdicts, "sub", "left")
    accepted, missing = F.coalesce(F.col("routing") == "auto_accept", F.lit(False)), F.col("routing").isNull()
    edges = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(accepted, F.col("edges"))))))
    out = j.groupBy("parent").agg(
        F.count("*").alias("n_subproblems"), F.count_if(accepted).alias("n_resolved"), F.count_if(~missing & ~accepted).alias("failed"), F.count_if(missing).alias("unvoted"), edges.alias("union_edges")
    )
    status = F.when(F.col("failed") > 0, "failed").when(F.col("unvoted") > 0, "unvoted").otherwise("complete")
    return out.select("parent", status.alias("status"), "n_subproblems", "n_resolved", "union_edges")


def set_labels(pairs: DataFrame) -> DataFrame:
    """group_id, ref_ids, target_ids of labels that are artefacts of a cross product, from pairs (group_id, ref_id, target_id, labelled, chosen).

    pairs is a group's universe. A label is an artefact if it has two sides of two and more, goes beyond
    what was chosen, and equals all pairs of the universe between its sides.
    """
    lab = pairs.filter("labelled").select("group_id", "ref_id", "target_id")
    refs, targets = lab.select("group_id", "ref_id").distinct(), lab.select("group_id", "target_id").distinct()
    grid = pairs.join(refs, ["group_id", "ref_id"], "left_semi").join(targets, ["group_id", "target_id"], "left_semi")
    counts = grid.groupBy("group_id").agg(
        F.bool_and("labelled").alias("whole"), F.bool_or(F.col("labelled") & ~F.col("chosen")).alias("beyond"),
        F.array_sort(F.collect_set(F.when(F.col("labelled"), F.col("ref_id")))).alias("ref_ids"), F.array_sort(F.collect_set(F.when(F.col("labelled"), F.col("target_id")))).alias("target_ids"),
    )
    return counts.filter("whole AND beyond AND size(ref_ids) > 1 AND size(target_ids) > 1").select("group_id", "ref_ids", "target_ids")


def standing_decisions(actions: DataFrame, entity: str, action: Column, undo: Column, *order: str) -> DataFrame:
    """entity, decision, n: the decision on top of each entity's stack and its height, after undos have each taken one off."""
    steps = actions.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct(*order, undo.alias("undo"), action.alias("action")))).alias("steps"))
    empty = F.array().cast("array<string>")
    pop = lambda s: F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))
    stack = F.aggregate("steps", empty, lambda s, x: F.when(x["undo"], pop(s)).otherwise(F.array_append(s, x["action"])))
    out = steps.select(entity, stack.alias("stack")).filter(F.size("stack") > 0)
    return out.select(entity, F.element_at("stack", -1).alias("decision"), F.size("stack").cast("long").alias("n"))


def chosen_model(rows: DataFrame, name: str, by: str, least: float = 0.5) -> DataFrame:
    """by, coverage, model: the full model where enough rows have a name, else the one of geometry only."""
    has = F.when(F.length(F.trim(F.coalesce(F.col(name), F.lit("")))) > 0, 1.0).otherwise(0.0)
    out = rows.groupBy(by).agg(F.avg(has).alias("coverage"))
    return out.withColumn("model", F.when(F.col("coverage") >= least, "full").otherwise("geometry"))
