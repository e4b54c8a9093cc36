"""Scorer training with pyspark.ml: boosted trees, isotonic calibration, grouped folds."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import matching


def train(rows: DataFrame, features: list[str], label: str = "y", trees: int = 20, depth: int = 4, seed: int = 7):
    """A boosted-tree pipeline; missing values are imputed and marked by indicator columns."""
    marked = with_indicators(rows, features)
    names = [*(f"{f}__i" for f in features), *(f"{f}__missing" for f in features)]
    stages = [
        Imputer(inputCols=features, outputCols=[f"{f}__i" for f in features]), VectorAssembler(inputCols=names, outputCol="features"),
        GBTClassifier(labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth, seed=seed),
    ]
    return Pipeline(stages=stages).fit(marked)


def with_indicators(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.withColumns({f"{f}__missing": F.col(f).isNull().cast("double") for f in features})


def predict(model, rows: DataFrame, features: list[str]) -> DataFrame:
    """rows with p, the raw match probability."""
    out = model.transform(with_indicators(rows, features)).withColumn("p", vector_to_array("probability")[1])
    return out.select(*rows.columns, "p")


def fit_isotonic(rows: DataFrame, p: str = "p", label: str = "y") -> list[tuple[float, float]]:
    """Knots of a monotone calibration; bounded by the distinct probabilities kept by the fit."""
    m = IsotonicRegression(featuresCol=p, labelCol=label).fit(rows.select(p, label))
    return list(zip(m.boundaries.toArray().tolist(), m.predictions.toArray().tolist(), strict=True))


def grouped_folds(rows: DataFrame, left: str, right: str, folds: int = 5) -> DataFrame:
    """rows with fold: pairs that share an id, directly or over other pairs, stay together."""
    edges = rows.select(F.concat(F.lit("l:"), left).alias("u"), F.concat(F.lit("r:"), right).alias("v"))
    own = matching.components(edges).withColumnRenamed("node", "__n")
    out = rows.join(own, F.concat(F.lit("l:"), left) == F.col("__n")).drop("__n")
    return out.withColumn("fold", F.pmod(F.xxhash64("component"), F.lit(folds))).drop("component")


def class_predictor(rows: DataFrame, features: list[str], label: str, seed: int = 7):
    """A random forest over numeric attributes for missing classes."""
    stages = [StringIndexer(inputCol=label, outputCol="__y", handleInvalid="skip"), VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), RandomForestClassifier(labelCol="__y", numTrees=20, maxDepth=6, seed=seed)]
    return Pipeline(stages=stages).fit(rows)


def assembled(rows: DataFrame, keys: list[str], features: list[tuple[str, Column, float]]) -> DataFrame:
    """keys, the features in contract order, failed: a feature that is null or not a number takes its default.

    failed is true where none of the features could be computed.
    """
    bad = lambda c: c.isNull() | F.isnan(c)
    raw = rows.select(*keys, *[c.cast("double").alias(n) for n, c, _ in features])
    failed = F.lit(True)
    for n, _, _ in features:
        failed = failed & bad(F.col(n))
    return raw.select(*keys, *[F.when(bad(F.col(n)), F.lit(float(d))).otherwise(F.col(n)).alias(n) for n, _, d in features], failed.alias("failed"))


def leave_one_out(rows: DataFrame, by: str, features: list[str], label: str = "y", **how) -> DataFrame:
    """by, n, precision, recall, f1: each value of by is held out once, predicted by a model of the others.

    Values are few (dataset types): one model is fitted for each of them.
    """
    out = None
    for v in sorted(r[0] for r in rows.select(by).distinct().collect() if r[0] is not None):
        kept, held = rows.filter(~F.col(by).eqNullSafe(F.lit(v))), rows.filter(F.col(by) == v)
        if kept.select(label).distinct().count() < 2:
            continue
        said = predict(train(kept, features, label, **how), held, features).select(F.lit(v).alias(by), F.col(label).alias("y"), (F.col("p") >= 0.5).alias("said"))
        out = said if out is None else out.unionByName(said)
    if out is None:
        return rows.sparkSession.createDataFrame([], f"{by} string, n long, precision double, recall double, f1 double")
    tp, fp, fn = F.count_if(F.col("said") & (F.col("y") == 1)), F.count_if(F.col("said") & (F.col("y") == 0)), F.count_if(~F.col("said") & (F.col("y") == 1))
    n = out.groupBy(by).agg(F.count("*").alias("n"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    ratio = lambda a, b: F.round(F.try_divide(a, b), 6)
    return n.select(by, "n", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))
