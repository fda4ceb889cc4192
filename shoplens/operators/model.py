"""Boosted-tree classifiers on the feature matrix and their blended score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.session import shared_folder

# Boosting rounds, tree depth, learning rate, row and column sampling, seed, blend weights.
ROUNDS = (700, 1000, 1300)
TREE_SETTINGS = {
    "maxDepth": 8,
    "stepSize": 0.05,
    "subsamplingRate": 0.95,
    "featureSubsetStrategy": "0.2",
    "seed": 100,
}
BLEND_WEIGHTS = (1.0, 1.0, 1.0 / 3.0)


# Fixed value: histogram bins per feature of the reference run's learner.
TREE_SETTINGS["maxBins"] = 255


@dataclass(frozen=True)
class Boosters:
    features: list[str]
    models: list[GBTClassificationModel]


def _assembled(sample: DataFrame, features: list[str]) -> DataFrame:
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    return assembler.transform(sample)


def train_boosters(
    sample: DataFrame, features: list[str], label: str = "flag",
    rounds: tuple[int, ...] = ROUNDS, **settings,
) -> Boosters:
    """One classifier per number of rounds, on features without NULLs, as the matrix has them.

    Only the longest is fitted. Boosting is sequential and its settings and seed are shared, so a
    shorter model is the longest one's first trees (:func:`prefix`).

    Trees are grown from distributed histograms. Every tenth round is checkpointed in the shared
    folder, which keeps the lineage of a long run short. The assembled vectors are kept, spilling
    to disk, for the rounds that share them; a lost part is assembled again.
    """
    context = sample.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(sample.sparkSession))
    rows = _assembled(sample, features).select("features", F.col(label).cast("double").alias("label"))
    options = {**TREE_SETTINGS, "checkpointInterval": 10, **settings}
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        longest = GBTClassifier(maxIter=max(rounds), **options).fit(rows)
        return Boosters(features, [longest if r == max(rounds) else prefix(longest, r) for r in rounds])
    finally:
        rows.unpersist()


def prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds`` rounds."""
    java, context = model._java_obj, SparkContext._active_spark_context
    trees = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    for i, tree in enumerate(java.trees()[:rounds]):
        trees[i] = tree
    weights = context._gateway.new_array(context._gateway.jvm.double, rounds)
    for i, weight in enumerate(java.treeWeights()[:rounds]):
        weights[i] = weight
    short = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{rounds}", trees, weights)
    return GBTClassificationModel(short)


def blended_score(
    boosters: Boosters, sample: DataFrame, weights: tuple[float, ...] = BLEND_WEIGHTS
) -> DataFrame:
    """Weighted sum of the models' probabilities as ``score``; weights of 1/3 each give the mean."""
    check_weights(len(boosters.models), weights)
    parts = [f"probability_{i}" for i in range(len(boosters.models))]
    return blend(probabilities(boosters, sample), parts, weights).drop(*parts)


def check_weights(models: int, weights: tuple[float, ...]) -> None:
    if models != len(weights):
        raise ValueError(f"{models} models need as many weights, found {len(weights)}")


def probabilities(boosters: Boosters, sample: DataFrame) -> DataFrame:
    """``sample`` with one column ``probability_<i>`` per model."""
    rows = _assembled(sample, boosters.features)
    for i, model in enumerate(boosters.models):
        model = model.copy()
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(f"probability_{i}")
        rows = model.transform(rows).withColumn(f"probability_{i}", vector_to_array(F.col(f"probability_{i}"))[1])
    return rows.drop("features")


def blend(rows: DataFrame, parts: list[str], weights: tuple[float, ...] = BLEND_WEIGHTS) -> DataFrame:
    """``rows`` with ``score``, the weighted sum of the columns ``parts``."""
    check_weights(len(parts), weights)
    score = F.lit(weights[0]) * F.col(parts[0])
    for weight, part in zip(weights[1:], parts[1:], strict=True):
        score = score + F.lit(weight) * F.col(part)
    return rows.withColumn("score", score)


def area_under_curve(scored: DataFrame, label: str = "flag") -> float | None:
    """AUC of a scored, labelled sample, such as the held-out anchor; every distinct score counts.
    None if the sample lacks one of the two labels."""
    rows = scored.select(F.col("score").cast("double"), F.col(label).cast("double").alias("label"))
    if rows.agg(F.count_distinct("label")).first()[0] < 2:
        return None
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(rows)
