"""Quality classifier by compression.

Two zstandard dictionaries of one size are built from blocks of good and of bad labelled text. Every
document is compressed with both, block by block over its whole text; the difference of the
compressed sizes, as a share of their sum, is turned into a probability by a logistic curve fitted on
other labelled documents.

Bounded sample: dictionaries learn from at most ``DICTIONARY_DOCS`` documents per label and
``BLOCKS`` blocks of each, the curve from at most ``CURVE_DOCS`` documents per label, all chosen by a
hash of the id. Scoring covers all documents and whole texts.

Defined results: null and empty texts carry no evidence and get the curve's value at 0; ids without
label are scored like others; contradicting labels are not learnt from; with no or one class of
labels every score is the share of label 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slices, texts
from shoplens.llm.labels import fold, logistic, sample, scored, training_labels

DICTIONARY_DOCS, BLOCKS, CURVE_DOCS = 2000, 4, 4000
BLOCK_BYTES, DICTIONARY_BYTES, LEVEL = 2048, 112 << 10, 3


def blocks_of(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]


def spread_blocks(text: bytes, most: int = BLOCKS) -> list[bytes]:
    """At most ``most`` blocks, evenly spread over the text."""
    found = blocks_of(text)
    if len(found) <= most:
        return found
    return [found[round(i * (len(found) - 1) / (most - 1))] for i in range(most)]


def dictionary(blocks: list[bytes]) -> bytes:
    """Raw content for a dictionary: what the trainer picks, or the blocks if they are too few for it."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[:DICTIONARY_BYTES]


class Sizer:
    """Compressed sizes of a text under the dictionaries for bad and good text."""

    def __init__(self, contents: tuple[bytes, bytes]) -> None:
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.compressors = []
        for content in contents:
            known = zstandard.ZstdCompressionDict(content) if content else None
            if known:
                known.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, **options))

    def evidence(self, text: bytes) -> float:
        """(bad size - good size) / their sum: positive where the good dictionary fits better."""
        blocks = blocks_of(text)
        bad, good = (sum(len(c.compress(b)) for b in blocks) for c in self.compressors)
        return (bad - good) / (bad + good) if blocks else 0.0


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    curve: tuple[float, float]


def _evidence(docs: DataFrame, contents: tuple[bytes, bytes], keep: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(contents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(sent.value)
        for batch in slices(batches):
            found = pa.array([sizer.evidence(t) for t in texts(batch)], pa.float64())
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], found], [*names, "evidence"])

    return docs.mapInArrow(run, f"{keep}, evidence double")


def _blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(label, b) for label, t in zip(batch.column("label").to_pylist(), texts(batch), strict=True) for b in spread_blocks(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], ["label", "block"]
            )

    return docs.select("label", "text").mapInArrow(run, "label int, block binary")


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", seed: int = 9) -> Model:
    """Dictionaries and curve from the labelled rows that may be learnt from."""
    usable = training_labels(labels, column).withColumn("_fold", fold(F.col("doc_id"), 3, seed))
    texts_of = docs.select("doc_id", "text")
    # Both samples are bounded by parameters, so that their ids can be broadcast at any size.
    first = sample(usable.where("_fold > 0"), DICTIONARY_DOCS, seed)
    rows = _blocks(texts_of.join(F.broadcast(first), "doc_id")).collect()
    by_label = {value: sorted({bytes(r["block"]) for r in rows if r["label"] == value}) for value in (0, 1)}
    # As many bytes of either class: the richer one must not win by size.
    room = min(sum(map(len, b)) for b in by_label.values())
    contents = []
    for value in (0, 1):
        order = np.random.default_rng(seed).permutation(len(by_label[value]))
        picked, taken = [], 0
        for i in order:
            if taken < room:
                picked.append(by_label[value][i])
                taken += len(picked[-1])
        contents.append(dictionary(picked))
    second = sample(usable.where("_fold = 0"), CURVE_DOCS, seed).select("doc_id", "label")
    measured = _evidence(texts_of.join(F.broadcast(second), "doc_id").select("label", "text"), tuple(contents), "label int").collect()
    label = np.array([r["label"] for r in measured], "float64")
    value = np.array([r["evidence"] for r in measured], "float64")
    shares = {r["label"]: r["n"] for r in usable.where("_fold = 0").groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = np.where(label == 1, shares.get(1, 0) / max(1, np.sum(label == 1)), shares.get(0, 0) / max(1, np.sum(label == 0)))
    return Model(*contents, logistic(value, label, weight))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, evidence, predicted) per row."""
    found = _evidence(docs.select(F.col("doc_id").cast("long"), "text"), (model.bad, model.good), "doc_id bigint")
    return scored(found, F.col("evidence"), model.curve, threshold)
