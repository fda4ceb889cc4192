"""Hard negatives by exact inner products, with length buckets and coordinate pruning.

Rows are ordered by label and falling length and cut into buckets of ``BUCKET_ROWS``. An anchor asks for the
first rows whose score lies in given intervals; the least score it still needs is its threshold. A bucket
whose longest vector cannot reach the threshold is not visited. In a bucket, coordinates are held as sorted
lists: of a unit vector whose cosine with the anchor reaches the local threshold, each coordinate lies in a
feasible range around the anchor's own. The ranges of the anchor's ``FOCUS`` largest coordinates are
intersected, and what is left is compared exactly. Two rounds: what one bucket holds raises the threshold for
all others.

Anchors travel in blocks of ``BLOCK_ROWS`` at most, so no task holds more than a bucket and a block. The
broadcast holds three numbers per bucket, which is less than a thousandth of the vectors.

Defined results: components are floor(256 * x), scores their integer inner products (beyond 64 bits they
count as the nearest long); missing trailing components count as zero;
rows with a null label or vector, or a null or non-finite component (also after scaling), take no part; rows
without id are never anchors and come last among ties; repeated rows are rows of their own; ties go to the
smaller id; an anchor without positive or negatives gives no rows; an empty table gives none; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import written
from shoplens.llm.ordering import numbered

BUCKET_ROWS, BLOCK_ROWS, FOCUS = 4096, 8192, 3
SCALE = 256
# Sums of products up to this size are exact in double precision.
EXACT = float(1 << 53)
LONG = np.iinfo("int64")
# Room for rounding in the bounds of lengths and coordinates.
SLACK = 1e-9
NO_ID = int(LONG.max)


def encoded(vector: np.ndarray) -> bytes:
    """Whole numbers in two bytes each where they fit, else as doubles; the first byte says which."""
    small = not len(vector) or np.abs(vector).max() < 1 << 15
    return (b"\x02" if small else b"\x08") + vector.astype("<i2" if small else "<f8").tobytes()


def decoded(values: list[bytes]) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    rows = [np.frombuffer(v, "<i2" if v[0] == 2 else "<f8", offset=1) for v in values]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector, shorter: minus the length) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.offsets) - column.offsets[0].as_py()
            with np.errstate(over="ignore"):
                whole = [np.floor(SCALE * flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            kept = np.array([bool(np.isfinite(x).all()) for x in whole], bool)
            with np.errstate(over="ignore"):
                lengths = np.array([-np.sqrt(x @ x) if k else 0.0 for x, k in zip(whole, kept, strict=True)], "float64")
            columns = [batch.column("vec_id"), batch.column("label"), pa.array([encoded(x) if k else None for x, k in zip(whole, kept, strict=True)], pa.binary()), pa.array(lengths)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "shorter"]).filter(pa.array(kept))

    plain = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    given = plain.where(F.col("label").isNotNull() & F.coalesce(F.forall("embedding", lambda x: x.isNotNull()), F.lit(False)))
    return given.mapInArrow(run, "vec_id bigint, label bigint, vector binary, shorter double")


def feasible(own: float, cosine: float) -> tuple[float, float]:
    """Range of a coordinate of unit vectors whose cosine with one that has ``own`` there is at least ``cosine``."""
    wide = np.sqrt(max(0.0, (1 - own * own) * (1 - cosine * cosine)))
    low = -1.0 if own <= -cosine else own * cosine - wide
    high = 1.0 if own >= cosine else own * cosine + wide
    return low - SLACK, high + SLACK


class Bucket:
    """Vectors of one bucket with the sorted list of each coordinate."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        with np.errstate(all="ignore"):
            lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.longest = lengths.max(initial=0)
        self.largest = np.abs(vectors).max(initial=0)
        self.prunable = bool(np.isfinite(unit).all() and np.isfinite(self.longest))
        self.unit = unit
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, anchor: np.ndarray, threshold: float) -> np.ndarray:
        """Rows that may have a score of ``threshold`` or more."""
        everything = np.arange(len(self.vectors))
        length = np.sqrt(anchor @ anchor)
        if not self.prunable or not np.isfinite(length) or threshold <= 0:
            return everything
        reach = length * self.longest
        if threshold > reach * (1 + SLACK):
            return everything[:0]
        cosine = min(1.0, threshold / reach) * (1 - SLACK)
        own = anchor / length
        focus = np.argsort(-np.abs(own), kind="stable")[:FOCUS]
        ranges = []
        for f in focus:
            low, high = feasible(own[f], cosine)
            ends = np.searchsorted(self.sorted[:, f], [low, high], side="left")
            ends[1] = np.searchsorted(self.sorted[:, f], high, side="right")
            ranges.append((ends[1] - ends[0], f, ends, low, high))
        ranges.sort(key=lambda x: x[0])
        _, f, ends, _, _ = ranges[0]
        found = self.order[ends[0] : ends[1], f]
        for _, f, _, low, high in ranges[1:]:
            values = self.unit[found, f]
            found = found[(values >= low) & (values <= high)]
        return found

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores, as Python integers where doubles would round."""
        if self.largest * np.abs(anchor).max(initial=0) * max(1, len(anchor)) < EXACT:
            return (self.vectors[rows] @ anchor).astype("int64")
        whole = [int(x) for x in anchor]
        exact = (sum(int(x) * y for x, y in zip(self.vectors[r], whole, strict=True)) for r in rows)
        return np.array([min(max(s, int(LONG.min)), int(LONG.max)) for s in exact], "int64")


FOUND = "row bigint, part int, other bigint, vec_id bigint, score bigint"


def _search(key: tuple, rows: pa.Table, asked: pa.Table, k: int, same: bool) -> pa.Table:
    """The first ``k`` rows of a bucket in each interval of each anchor of a block."""
    parts: list[tuple] = []
    if rows.num_rows and asked.num_rows:
        both = decoded(rows.column("vector").to_pylist() + asked.column("vector").to_pylist())
        bucket, anchors = Bucket(both[: rows.num_rows]), both[rows.num_rows :]
        labels, places = rows.column("label").to_numpy(), rows.column("place").to_numpy()
        ids = rows.column("vec_id").fill_null(NO_ID).to_numpy()
        names, own, lows, highs = (asked.column(c).to_pylist() for c in ("row", "label", "low", "high"))
        for anchor, row, label, low, high in zip(anchors, names, own, lows, highs, strict=True):
            at = bucket.candidates(anchor, min(low, default=0))
            at = at[((labels[at] == label) == same) & (places[at] != row)]
            scores = bucket.scores(anchor, at)
            # The complement falls as the score rises, and has no overflow.
            order = np.lexsort((places[at], ids[at], ~scores))
            at, scores = at[order], scores[order]
            for part, (least, most) in enumerate(zip(low, high, strict=True)):
                chosen = np.flatnonzero((scores >= least) & (scores <= most))[:k]
                parts += [(row, part, places[i], ids[i], int(s)) for i, s in zip(at[chosen], scores[chosen], strict=True)]
    columns = list(zip(*parts, strict=True)) if parts else [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["row", "part", "other", "vec_id", "score"])


def _first_bucket(number: int, label: int, low: np.ndarray, high: np.ndarray, same: bool) -> int:
    """The bucket of the first round: the anchor's own, or the next that holds other labels."""
    if same:
        return number
    for step in range(1, len(low) + 1):
        at = (number + step) % len(low)
        if low[at] != label or high[at] != label:
            return at
    return number


def _visits(asking: DataFrame, summary: tuple, blocks: int, same: bool, first: bool) -> DataFrame:
    """(bucket, block, row, label, vector, low, high): anchors at the buckets that they cannot rule out."""
    sent = asking.sparkSession.sparkContext.broadcast(summary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, longest = sent.value
        for batch in batches:
            lengths = -batch.column("shorter").to_numpy()
            at, to = [], []
            for i, (row, label, lows) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "label", "low")), strict=True)):
                start = _first_bucket(row // BUCKET_ROWS, label, low, high, same)
                fits = (low <= label) & (high >= label) if same else (low != label) | (high != label)
                if first:
                    wanted = np.array([start]) if fits[start] else np.empty(0, "int64")
                else:
                    fits[start] = False
                    threshold = min(lows, default=0)
                    wanted = np.flatnonzero(fits & ~(threshold > longest * lengths[i] * (1 + SLACK)) if threshold > 0 else fits)
                at.append(np.full(len(wanted), i))
                to.append(wanted)
            at, to = np.concatenate([*at, np.empty(0, "int64")]).astype("int64"), np.concatenate([*to, np.empty(0, "int64")]).astype("int64")
            for i in range(0, len(at), BLOCK_ROWS):
                part = batch.select(["row", "label", "vector", "low", "high"]).take(pa.array(at[i : i + BLOCK_ROWS]))
                block = (part.column("row").to_numpy() // SCALE % blocks).astype("int64")
                yield pa.RecordBatch.from_arrays([pa.array(to[i : i + BLOCK_ROWS]), pa.array(block), *part.columns], ["bucket", "block", *part.schema.names])

    plain = asking.select("row", "label", "shorter", "vector", "low", "high")
    return plain.mapInArrow(run, "bucket bigint, block bigint, row bigint, label bigint, vector binary, low array<bigint>, high array<bigint>")


def first_in_intervals(rows: DataFrame, asking: DataFrame, summary: tuple, blocks: int, k: int, same: bool) -> DataFrame:
    """(row, part, other, vec_id, score, rank): for each row of ``asking`` (row, label, vector, shorter, low,
    high) and interval [low, high] of a part, the first ``k`` rows of the same or of different labels."""

    def search(key: tuple, bucket: pa.Table, asked: pa.Table) -> pa.Table:
        return _search(key, bucket, asked, k, same)

    dealt = rows.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "place", "vec_id", "label", "vector")
    order = Window.partitionBy("row", "part").orderBy(F.desc("score"), "vec_id", "other")

    def asked_of(visits: DataFrame, name: str) -> DataFrame:
        found = dealt.groupBy("bucket", "block").cogroup(visits.groupBy("bucket", "block")).applyInArrow(search, FOUND)
        return written(found, name)

    near = asked_of(_visits(asking, summary, blocks, same, True), "near")
    # The last of k found is what others have to reach.
    reached = near.groupBy("row", "part").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") >= k)
    reached = reached.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("part", "score"))).alias("reached"))
    raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("reached", i.cast("int")), x)))
    later = asking.join(reached, "row", "left").withColumn("low", F.coalesce(F.when(F.col("reached").isNotNull(), raised), F.col("low")))
    both = near.unionByName(asked_of(_visits(later, summary, blocks, same, False), "far"))
    ranked = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return written(ranked.withColumn("vec_id", F.when(F.col("vec_id") != NO_ID, F.col("vec_id"))), "ranked")


def mine(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``vectors`` (vec_id,
    label, embedding): of each row where ``anchor`` holds (a column of vec_id), its first ``positives`` rows of the
    same label, and for each the first ``negatives`` of other labels whose score is ``least`` to ``most`` percent."""
    whole = written(whole_vectors(vectors).withColumn("all", F.lit(0)), "vectors")
    ordered = numbered(whole, "all", ["label", "shorter", "vec_id"], "place", "rows").drop("all", "rows")
    rows = written(ordered.withColumn("bucket", F.floor(F.col("place") / BUCKET_ROWS)), "buckets")
    held = rows.groupBy("bucket").agg(F.min("label"), F.max("label"), F.max(-F.col("shorter"))).orderBy("bucket").toArrow()
    summary = tuple(held.column(i).to_numpy() for i in (1, 2, 3))
    chosen = rows.where(F.coalesce(anchor, F.lit(False))).select(F.col("place").alias("row"), F.col("vec_id").alias("anchor_id"), "label", "vector", "shorter")
    anchors = written(chosen, "anchors")
    # Rows of a bucket meet one block of anchors at a time; blocks are dealt by the row's number.
    blocks = max(1, -(-anchors.count() // BLOCK_ROWS))
    ends = {"low": F.array(F.lit(int(LONG.min))), "high": F.array(F.lit(int(LONG.max)))}
    near = first_in_intervals(rows, anchors.withColumns(ends), summary, blocks, positives, True)
    # Only scores from zero up leave an interval: least percent of a negative score is above most percent.
    near = near.where("score >= 0").select("row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    asked = F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score")))
    lists = near.groupBy("row").agg(asked.alias("asked"))
    share = F.col("positive_score").cast("decimal(30,0)")
    low, high = F.ceil(share * least / 100).cast("long"), F.floor(share * most / 100).cast("long")
    spans = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", low.alias("low"), high.alias("high")))).alias("s"))
    asking = anchors.join(lists, "row").join(spans, "row").withColumns({"low": F.col("s.low"), "high": F.col("s.high")}).drop("s")
    asking = written(asking, "asking")
    found = first_in_intervals(rows, asking, summary, blocks, negatives, False)
    joined = found.join(asking.select("row", "anchor_id", "asked"), "row").withColumn("positive", F.element_at("asked", F.col("part") + 1))
    return joined.select(
        "anchor_id", "positive.positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive.positive_score", F.col("score").alias("negative_score")
    )
