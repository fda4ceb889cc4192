"""Labels of documents, the split that models may learn from, and one-dimensional calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import held_out

# A side of at most this many (id, label) rows, about 64 MB, is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 4_000_000


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of rows that models may learn from. Repeated rows count once; ids with
    contradicting labels, null ids and labels other than 0 and 1 are left out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out(F.col("doc_id")))
    grouped = usable.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("_other"))
    return grouped.where("label = _other").select("doc_id", F.col("label").cast("int").alias("label"))


def fold(doc_id: Column, folds: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit(seed)), F.lit(folds))


def attach(docs: DataFrame, labelled: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Documents with a label. Labels are broadcast only if their count says that they fit."""
    small = labelled.count() <= most_rows
    return docs.join(F.broadcast(labelled) if small else labelled, "doc_id")


def sample(labelled: DataFrame, per_class: int, seed: int) -> DataFrame:
    """At most ``per_class`` rows of each label, chosen by a hash of the id."""
    parts = [
        labelled.where(F.col("label") == value).orderBy(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def logistic(values: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """(slope, intercept) of a logistic curve, by damped Newton steps with a slight ridge.

    Without both classes the slope is 0 and the intercept gives the share of label 1.
    """
    if not len(values):
        return 0.0, 0.0
    share = (np.sum(weight * label) + 0.5) / (np.sum(weight) + 1)
    start = float(np.log(share / (1 - share)))
    scale = float(np.std(values))
    if scale == 0 or label.min() == label.max():
        return 0.0, start
    x = np.stack([values / scale, np.ones(len(values))], axis=1)
    ridge = np.diag([1e-3, 1e-6]) * np.sum(weight) / len(values)
    loss = lambda b: np.sum(weight * (np.logaddexp(0, x @ b) - label * (x @ b))) + b @ ridge @ b / 2
    beta, now = np.array([0.0, start]), None
    now = loss(beta)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (weight * (p - label)) + ridge @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        while loss(beta - step) > now and np.abs(step).max() > 1e-12:
            step = step / 2
        beta = beta - step
        now = loss(beta)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]) / scale, float(beta[1])


def scored(df: DataFrame, value: Column, curve: tuple[float, float], threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) and ``value`` itself."""
    slope, intercept = curve
    score = 1 / (1 + F.exp(-(F.lit(slope) * value + F.lit(intercept))))
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), value.alias("evidence")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
