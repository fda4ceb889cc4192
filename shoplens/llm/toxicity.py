"""Toxicity by class-conditional Kneser-Ney models.

Two models of how words are spelt, one of toxic and one of ordinary text, predict each character of
a word from the ``ORDER - 1`` before it. Each level of a class's model backs off to its own
continuation counts; at ``SHARED`` characters and below, and in the uniform base, both classes
back off to the same counts, so that rare expressions speak for neither. Inflected and compound forms
of an expression share its character grams.

The evidence of a text is the mean over its words of what a word's log-likelihood ratio (toxic over
ordinary) exceeds ``MARGIN`` by: length-normalised, and free of the small differences that language and
topic give to all words. A logistic curve on documents kept aside turns it into a score.

Counts cover all labelled rows that may be learnt from, but a fifth kept for the curve; a word
counts once per document. A gram counts from ``LEAST_COUNT`` documents of a class on, whatever the size of the
corpus; so the model grows with the corpus, as the spellings of its vocabulary do, and is sent as plain
arrays. The curve is fitted on one text of at most ``CURVE_DOCS`` document ids per label.

Defined results: null, empty and wordless texts have evidence 0; words are runs of letters and
digits in lower case; contradicting labels are not learnt from; with no or one class of labels every
score is the share of label 1; rows repeated with one ``doc_id`` get a row each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slices, worker_cache
from shoplens.llm.labels import attach, fold, logistic, sample, scored, training_labels

ORDER, SHARED, DISCOUNT, MARGIN = 5, 2, 0.75, 3.0
# Documents of a class that a gram must be in to count, at every size of the corpus.
LEAST_COUNT = 2
CURVE_FOLDS, CURVE_DOCS = 5, 10_000
BEFORE, AFTER = 1, 2  # code points that stand for the ends of a word
UNIFORM = 1 / 256
# Words a task tallies before it sends them on, and words a worker remembers.
TALLIED, REMEMBERED = 300_000, 500_000


def words_in(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the gram that ends at each character of each word and at its end, one row
    each, and the word's number."""
    sizes = np.fromiter(map(len, words), "int64", len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    width = sizes + ORDER
    first, first_letter = np.cumsum(width) - width, np.cumsum(sizes) - sizes
    flat = np.full(int(width.sum()), BEFORE, "uint32")
    flat[np.repeat(first + ORDER - 1 - first_letter, sizes) + np.arange(len(letters))] = letters
    flat[first + width - 1] = AFTER
    steps = sizes + 1
    at = np.repeat(first - (np.cumsum(steps) - steps), steps) + np.arange(int(steps.sum()))
    return np.stack([flat[at + j] for j in range(ORDER)], axis=1), np.repeat(np.arange(len(words)), steps)


def _keys(grams: np.ndarray) -> np.ndarray:
    """64-bit hash of each row."""
    h = np.full(len(grams), grams.shape[1] + 1, "uint64")
    for column in grams.T:
        h = (h ^ column.astype("uint64")) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class Level:
    """One order: backoff weight by context, discounted probability by gram; columns ordinary, toxic."""

    contexts: np.ndarray
    backoff: np.ndarray
    grams: np.ndarray
    own: np.ndarray


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels from one character up, from distinct grams with their counts in either class."""
    levels, now, count = [], grams, counts.astype("float64")
    for order in range(ORDER, 0, -1):
        keys, first, place = np.unique(_keys(now), return_index=True, return_inverse=True)
        total = np.stack([np.bincount(place, count[:, c], len(keys)) for c in (0, 1)], axis=1)
        if order <= SHARED:
            total = np.repeat(np.bincount(place, minlength=len(keys))[:, None].astype("float64"), 2, axis=1)
        rows = now[first]
        contexts, of = np.unique(_keys(rows[:, :-1]), return_inverse=True)
        mass = np.stack([np.bincount(of, total[:, c], len(contexts)) for c in (0, 1)], axis=1)
        kinds = np.stack([np.bincount(of, total[:, c] > 0, len(contexts)) for c in (0, 1)], axis=1)
        backoff = np.where(mass > 0, DISCOUNT * kinds / np.maximum(mass, 1), 1.0)
        levels.append(Level(contexts, backoff, keys, np.maximum(total - DISCOUNT, 0) / np.maximum(mass, 1)[of]))
        # The next level counts in how many distinct longer grams a gram ends: continuation counts.
        now, count = rows[:, 1:], (total > 0).astype("float64")
    return levels[::-1]


def _rows(keys: np.ndarray, table: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], table[at], otherwise)


@dataclass(frozen=True)
class Model:
    levels: list[Level]
    curve: tuple[float, float] = (0.0, 0.0)

    def excess(self, words: list[str]) -> np.ndarray:
        """Per word what its log-likelihood ratio exceeds the margin by."""
        if not self.levels or not words:
            return np.zeros(len(words))
        grams, owner = grams_of(words)
        p = np.full((len(grams), 2), UNIFORM)
        for order, level in enumerate(self.levels, 1):
            part = grams[:, ORDER - order :]
            p = p * _rows(level.contexts, level.backoff, _keys(part[:, :-1]), 1.0) + _rows(level.grams, level.own, _keys(part), 0.0)
        ratio = np.bincount(owner, np.log(p[:, 1] / p[:, 0]), len(words))
        return np.maximum(ratio - MARGIN, 0.0)

    def arrays(self) -> tuple:
        """The model as plain arrays, as workers may lack the package."""
        return tuple((level.contexts, level.backoff, level.grams, level.own) for level in self.levels)

    @staticmethod
    def of_arrays(arrays: tuple) -> Model:
        return Model([Level(*level) for level in arrays])

    def mark(self) -> int:
        return zlib.crc32(b"".join(x.tobytes() for level in self.levels for x in (level.grams, level.own)))


def _text_list(batch: pa.RecordBatch) -> list[str]:
    return [x or "" for x in batch.column("text").to_pylist()]


def count_words(train: DataFrame) -> DataFrame:
    """(word, n0, n1): ordinary and toxic documents that hold a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for batch in slices(batches):
            for label, text in zip(batch.column("label").to_pylist(), _text_list(batch), strict=True):
                own = tally[label]
                for word in set(words_in(text)):
                    own[word] = own.get(word, 0) + 1
            if len(tally[0]) + len(tally[1]) > TALLIED:
                yield _tallied(*tally)
                tally = ({}, {})
        yield _tallied(*tally)

    counted = train.select("label", "text").mapInArrow(run, "word string, n0 bigint, n1 bigint")
    return counted.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _tallied(ordinary: dict[str, int], toxic: dict[str, int]) -> pa.RecordBatch:
    words = list(ordinary | toxic)
    columns = [pa.array(words, pa.string()), *[pa.array([t.get(w, 0) for w in words], pa.int64()) for t in (ordinary, toxic)]]
    return pa.RecordBatch.from_arrays(columns, ["word", "n0", "n1"])


def count_grams(words: DataFrame) -> DataFrame:
    """(gram, n0, n1) of the highest order, from words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, owner = grams_of(batch.column("word").to_pylist())
            names, place = np.unique(np.ascontiguousarray(grams).view(f"<U{ORDER}").ravel(), return_inverse=True)
            sums = [np.bincount(place, batch.column(c).to_numpy()[owner], len(names)).astype("int64") for c in ("n0", "n1")]
            yield pa.RecordBatch.from_arrays([pa.array(names.tolist(), pa.string()), *map(pa.array, sums)], ["gram", "n0", "n1"])

    counted = words.mapInArrow(run, "gram string, n0 bigint, n1 bigint")
    return counted.groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _judge(model: Model) -> Callable[[list[str]], list[float]]:
    """Function from texts to their evidence; a worker remembers the words of one model."""
    cache = worker_cache("toxicity")
    if cache.get("mark") != model.mark():
        cache.update(mark=model.mark(), words={})
    known = cache["words"]

    def judge(texts: list[str]) -> list[float]:
        split = [words_in(t) for t in texts]
        new = list(set().union(*split).difference(known))
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set().union(*split))
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            known.update(zip(part, model.excess(part).tolist(), strict=True))
        return [sum(map(known.__getitem__, w)) / len(w) if w else 0.0 for w in split]

    return judge


def _evidence(docs: DataFrame, model: Model, keep: str) -> DataFrame:
    """Columns of ``docs`` but ``text``, and ``evidence``."""
    sent = docs.sparkSession.sparkContext.broadcast(model.arrays())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(Model.of_arrays(sent.value))
        for batch in slices(batches, most_bytes=8 << 20):
            names = [n for n in batch.schema.names if n != "text"]
            found = pa.array(judge(_text_list(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], found], [*names, "evidence"])

    return docs.mapInArrow(run, f"{keep}, evidence double")


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", seed: int = 2) -> Model:
    """Counts over all labelled rows that may be learnt from, then the curve on those kept aside."""
    usable = training_labels(labels, column).withColumn("_fold", fold(F.col("doc_id"), CURVE_FOLDS, seed))
    plain = docs.select("doc_id", "text")
    counted = count_grams(count_words(attach(plain, usable.where("_fold > 0"))))
    frequent = counted.where((F.col("n0") >= LEAST_COUNT) | (F.col("n1") >= LEAST_COUNT)).orderBy("gram").toPandas()
    grams = np.frombuffer("".join(frequent["gram"]).encode("utf-32-le"), "<u4").reshape(-1, ORDER)
    model = Model(kneser_ney(grams, frequent[["n0", "n1"]].to_numpy("int64")) if len(grams) else [])
    aside = sample(usable.where("_fold = 0"), CURVE_DOCS, seed).select("doc_id", "label")
    # One row per id, that of the smallest text hash, whatever number of rows share it.
    texts = plain.join(F.broadcast(aside), "doc_id").select("doc_id", F.xxhash64("text").alias("_text"), "label", "text")
    found = _evidence(texts, model, "doc_id bigint, _text bigint, label int").groupBy("doc_id")
    rows = found.agg(F.min(F.struct("_text", "label", "evidence")).alias("r")).select("r.*").orderBy("_text").collect()
    label = np.array([r["label"] for r in rows], "float64")
    value = np.array([r["evidence"] for r in rows], "float64")
    shares = {r["label"]: r["n"] for r in usable.where("_fold = 0").groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = np.where(label == 1, shares.get(1, 0) / max(1, np.sum(label == 1)), shares.get(0, 0) / max(1, np.sum(label == 0)))
    return Model(model.levels, logistic(value, label, weight))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, evidence, predicted) per row."""
    found = _evidence(docs.select(F.col("doc_id").cast("long"), "text"), model, "doc_id bigint")
    return scored(found, F.col("evidence"), model.curve, threshold)


def filtered(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; nothing is shuffled. A curve
    without slope, for want of labels, rejects nothing."""
    slope, intercept = model.curve
    if slope == 0:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model.arrays())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(Model.of_arrays(sent.value))
        for batch in slices(batches, most_bytes=8 << 20):
            value = np.array(judge(_text_list(batch)))
            chance = 1 / (1 + np.exp(-(slope * value + intercept)))
            yield batch.filter(pa.array(chance < threshold))

    return docs.mapInArrow(run, docs.schema)
