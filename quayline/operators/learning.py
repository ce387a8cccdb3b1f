"""Chronologically split comparisons of classifiers and regressors, by the cluster's own learners."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chronological_split(data: DataFrame, ratio: float = 0.7, horizon: int = 1) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut less the horizon, rows from the cut on; none of either under five days.

    The days, not the rows, are ranked, so the one unpartitioned window sees as many rows as there are days.
    """
    days = data.select("date").distinct().withColumn("_k", F.row_number().over(Window.orderBy("date")) - 1)
    total = days.count()
    cut = int(total * ratio)
    marked = data.join(F.broadcast(days), "date")
    usable = marked if total >= 5 else marked.limit(0)
    return usable.where(F.col("_k") < max(0, cut - horizon)).drop("_k"), usable.where(F.col("_k") >= cut).drop("_k")


#: Rows of one partition of what a learner reads again and again; few rows in many tasks cost more than they save.
ROWS = 50_000


def laid_out(rows: DataFrame) -> DataFrame:
    """The rows in memory, in partitions of ``ROWS``."""
    return rows.repartition(max(1, math.ceil(rows.count() / ROWS))).cache()


def balanced(train: DataFrame, label: str = "target_up") -> DataFrame:
    """Adds ``weight``: rows over classes times the rows of the class."""
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, total / (len(counts) * n)).otherwise(weight)
    return train.withColumn("weight", weight)


def _classifiers(seed: int, trees: int, rounds: int) -> dict:
    common = {"featuresCol": "scaled", "labelCol": "target_up", "weightCol": "weight"}
    return {
        "logistic": LogisticRegression(maxIter=200, **common),
        "random_forest": RandomForestClassifier(numTrees=trees, maxDepth=5, minInstancesPerNode=8, seed=seed, **common),
        "gradient_boosting": GBTClassifier(maxIter=rounds, stepSize=0.05, maxDepth=2, seed=seed, featuresCol="scaled", labelCol="target_up"),
    }


def _prepared(features: list[str]) -> list:
    return [VectorAssembler(inputCols=features, outputCol="x"), StandardScaler(inputCol="x", outputCol="scaled", withMean=True)]


def classify(train: DataFrame, test: DataFrame, features: list[str], seed: int = 42, trees: int = 300, rounds: int = 150) -> dict[str, DataFrame]:
    """Predictions (ticker, date, target_up, pred_up, score) of each model; none where a side has one class."""
    both = [{r[0] for r in df.select("target_up").distinct().collect()} for df in (train, test)]
    if any(len(b) < 2 for b in both):
        return {}
    weighted = balanced(train)
    ready = Pipeline(stages=_prepared(features)).fit(weighted)
    fit, ask = laid_out(ready.transform(weighted).select("scaled", "target_up", "weight")), ready.transform(test)
    out = {}
    for name, model in _classifiers(seed, trees, rounds).items():
        predicted = model.fit(fit).transform(ask)
        out[name] = predicted.select("ticker", "date", "target_up", F.col("prediction").cast("int").alias("pred_up"), vector_to_array("probability")[1].alias("score"))
    ridge = LinearRegression(regParam=1.0, elasticNetParam=0.0, featuresCol="scaled", labelCol="y", weightCol="weight").fit(fit.withColumn("y", F.col("target_up") * 2.0 - 1.0))
    out["ridge"] = ridge.transform(ask).select("ticker", "date", "target_up", (F.col("prediction") > 0).cast("int").alias("pred_up"), F.col("prediction").alias("score"))
    return out


def regress(train: DataFrame, test: DataFrame, features: list[str], target: str = "target_return", seed: int = 42, trees: int = 300, rounds: int = 150) -> dict[str, DataFrame]:
    """Predictions (ticker, date, target, prediction) of each regressor."""
    ready = Pipeline(stages=_prepared(features)).fit(train)
    fit, ask = laid_out(ready.transform(train).select("scaled", target)), ready.transform(test)
    common = {"featuresCol": "scaled", "labelCol": target}
    models = {
        "linear": LinearRegression(**common),
        "ridge": LinearRegression(regParam=1.0, elasticNetParam=0.0, **common),
        "lasso": LinearRegression(regParam=0.001, elasticNetParam=1.0, **common),
        "random_forest": RandomForestRegressor(numTrees=trees, maxDepth=5, minInstancesPerNode=8, seed=seed, **common),
        "gradient_boosting": GBTRegressor(maxIter=rounds, stepSize=0.05, maxDepth=2, seed=seed, **common),
    }
    return {name: m.fit(fit).transform(ask).select("ticker", "date", F.col(target).alias("target"), "prediction") for name, m in models.items()}


def class_metrics(predicted: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC of (target_up, pred_up, score); AUC only with both classes."""
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target_up").evaluate(predicted) if predicted.select("target_up").distinct().count() == 2 else None
    cell = lambda p, y: F.sum(F.when((F.col("pred_up") == p) & (F.col("target_up") == y), 1.0).otherwise(0.0))
    tp, fp, fn, tn = cell(1, 1), cell(1, 0), cell(0, 1), cell(0, 0)
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return predicted.agg(F.count("*").alias("n_test"), safe(tp + tn, tp + fp + fn + tn).alias("accuracy"), safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"), safe(2 * tp, 2 * tp + fp + fn).alias("f1"), F.lit(auc).cast("double").alias("auc"))


def value_metrics(predicted: DataFrame) -> DataFrame:
    """RMSE, MAE and R squared of (target, prediction)."""
    gap = F.col("target") - F.col("prediction")
    return predicted.agg(F.count("*").alias("n_test"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"), (1 - F.try_divide(F.sum(gap * gap), F.var_pop("target") * F.count("*"))).alias("r2"))
