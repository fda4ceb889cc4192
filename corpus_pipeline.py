"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Toxic documents go; lines that many documents hold stay in one; one document of each class of near
duplicates stays; sources are brought to target shares by replication; what is left is packed into
token windows. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import line_dedup, mixing, packing, simhash, toxicity
from shoplens.llm.common import bounded_batches, stage_tables, table
from shoplens.session import HandOver

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """``stage`` with Arrow batches bounded by bytes."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below one half; the model learns from the input's own texts."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that three documents or more hold, but in the largest id."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the smallest id, and one of its rows. Linked are all whose
    five-word shingles have a Jaccard similarity of 0.8 or more: SimHash proposes, an exact join finds the rest."""
    return simhash.one_per_class(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at shares by the square root of their sizes, in a global random order."""
    return mixing.mix(docs).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a window."""
    return packing.pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _bounded(drop_toxic)),
    ("line_dedup", _bounded(drop_repeated_lines)),
    ("near_duplicates", _bounded(drop_near_duplicates)),
    ("mixing", _bounded(mix_sources)),
    ("packing", _bounded(pack_windows)),
]

# Trained scores, 64-bit hashes and tokenizers have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is a written table in the shared folder before the next one reads it. What a
    stage wrote on its way goes when its result is written, its input with it; the last result is lazy and keeps its own."""
    docs, input_store = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        store = HandOver(spark)
        with stage_tables():
            docs = store.put(name, stage(spark, docs, sf_dir))
        if input_store:
            input_store.close()
        input_store = store
    return STAGES[-1][1](spark, docs, sf_dir)
