"""The full prediction run: segments, models, selections, consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators import boosting, model, segments, selection
from shoplens.operators.samples import SAMPLE_KEYS
from shoplens.plans.features import feature_names
from shoplens.session import HandOver
from shoplens.settings import Calendar
from shoplens.sources.tables import write_result


def scored_days(
    sample: DataFrame, calendar: Calendar, rounds: tuple[int, ...] = model.ROUNDS,
    weights: tuple[float, ...] = model.BLEND_WEIGHTS, **settings,
) -> DataFrame:
    """Train on the early anchors of ``sample`` and score its last two; ``settings`` are those of
    :class:`boosting.Objective`. One training and one walk along the trees serve all ``rounds``."""
    model.check_weights(len(rounds), weights)
    features = feature_names(calendar.windows)
    objective = boosting.Objective(**settings)
    trained = boosting.train(segments.training_part(sample, calendar), features, max(rounds), objective=objective)
    late = sample.where(F.col("anchor_date") >= F.lit(calendar.before_last))
    scored = blended(trained, late, rounds, weights)
    return scored.select(*SAMPLE_KEYS, "anchor_date", "flag", "score")


def blended(
    trained: boosting.Boosted, sample: DataFrame, rounds: tuple[int, ...], weights: tuple[float, ...] = model.BLEND_WEIGHTS
) -> DataFrame:
    """``sample`` with the probability after each number of ``rounds`` and their weighted sum as ``score``."""
    parts = [f"probability_{i}" for i in range(len(rounds))]
    return model.blend(boosting.staged_probabilities(trained, sample, rounds), parts, weights)


def stage_aucs(trained: boosting.Boosted, sample: DataFrame, calendar: Calendar, rounds: tuple[int, ...], hand_over: HandOver) -> DataFrame:
    """(rounds, auc) on the held-out anchors, from one walk: how the model gains with its rounds."""
    walked = hand_over.put("stages", boosting.staged_probabilities(trained, held_out(sample, calendar), rounds))
    found = [(r, model.area_under_curve(walked.select(F.col(f"probability_{i}").alias("score"), "flag"))) for i, r in enumerate(rounds)]
    return sample.sparkSession.createDataFrame(found, "rounds int, auc double")


def held_out(sample: DataFrame, calendar: Calendar) -> DataFrame:
    """Samples of the anchors that are neither trained on nor scored."""
    day = F.col("anchor_date")
    return sample.where((day >= F.lit(calendar.train_before)) & (day < F.lit(calendar.before_last)))


def hold_out_auc(
    boosters: model.Boosters, sample: DataFrame, calendar: Calendar, weights: tuple[float, ...] = model.BLEND_WEIGHTS
) -> float:
    """AUC of the blended score on the held-out anchors."""
    held_out_rows = held_out(sample, calendar)
    return model.area_under_curve(model.blended_score(boosters, held_out_rows, weights))


def predict_lists(
    matrix: DataFrame, classes: DataFrame, calendar: Calendar, hand_over: HandOver,
    rounds: tuple[int, ...] = model.ROUNDS, weights: tuple[float, ...] = model.BLEND_WEIGHTS, **settings,
) -> dict[str, DataFrame]:
    """Lists of both segment models and of the pooled model, and their consensus as ``result``; ``settings``
    are those of :class:`boosting.Objective`.

    Scores are written before selection: each percentile reads them several times.
    """
    days = (calendar.last, calendar.before_last)
    # Written once: training and scoring of three groups read it.
    with_class = hand_over.put("with_class", matrix.join(classes.select("user_id", "user_class"), "user_id"))
    groups = {"segment2": [2], "segment3": [3], "pooled": [2, 3]}
    lists = {}
    for name, wanted in groups.items():
        sample = with_class.where(F.col("user_class").isin(*wanted)).drop("user_class")
        scored = hand_over.put(f"scores_{name}", scored_days(sample, calendar, rounds, weights, **settings))
        percents = selection.POOLED_PERCENTS if name == "pooled" else selection.SEGMENT_PERCENTS
        lists[name] = hand_over.put(name, selection.select_days(scored, days, percents))
    lists["result"] = selection.consensus(lists["pooled"], lists["segment2"], lists["segment3"])
    return lists


def write_lists(lists: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Write every list as a table of its own below ``folder``."""
    for name, selected in lists.items():
        write_result(selected, f"{folder}/{name}", fmt)
