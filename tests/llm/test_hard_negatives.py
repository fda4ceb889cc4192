"""Hard negatives against brute force with Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>, rank int, row string, bucket int"


def brute(rows, every=2, positives=5, negatives=3, least=50, most=95):
    good = [(i, v, label, [math.floor(256 * x) for x in e]) for i, (v, label, e) in enumerate(rows)
            if label is not None and e is not None and all(x is not None and math.isfinite(256 * x) for x in e)]
    last, out = (lambda v: (v is None, v or 0)), []

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    for i, v, label, q in good:
        if v is None or v % every:
            continue
        scored = [(-score(q, r), last(w), j, w, other) for j, w, other, r in good if j != i]
        scored.sort(key=lambda x: x[:2])
        own = [x for x in scored if x[4] == label][:positives]
        for s, _, _, w, _ in own:
            fits = [x for x in scored if x[4] != label and least * -s <= 100 * -x[0] <= most * -s][:negatives]
            out += [(v, w, rank + 1, x[3], -s, -x[0]) for rank, x in enumerate(fits)]
    return sorted(out, key=str)


def mined(spark, rows, **settings):
    plain = [(v, label, None if e is None else [None if x is None else float(x) for x in e]) for v, label, e in rows]
    df = spark.createDataFrame([(*r, None, "x", 3) for r in plain], SCHEMA)
    found = hard_negatives.mine(df, F.col("vec_id") % 2 == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def vectors(n, dims, labels, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels + 2, dims))
    spread = centres[rng.integers(0, labels + 2, n)] + 0.2 * rng.normal(size=(n, dims))
    return [(i, int(rng.integers(0, labels)), [float(x) for x in v * rng.uniform(0.2, 2)]) for i, v in enumerate(spread)]


def test_equals_brute_force_over_many_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET_ROWS", 32)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    rows = vectors(260, 6, 3, 1)
    # Ties, copies and rows repeated with their id.
    rows += [(1000 + i, 1, rows[5][2]) for i in range(40)] + [rows[4]] * 2 + [(2000 + i, i % 3, [0.0] * 6) for i in range(10)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(30, 3, 2, 2)
    rows += [(31, None, [1.0, 0, 0]), (32, 1, None), (34, 1, [1.0, None, 0]), (36, 0, [float("nan"), 0, 1]), (38, 0, [float("inf"), 0, 1])]
    rows += [(None, 0, [0.5, 0.1, 0.2]), (None, 1, [0.5, 0.1, 0.2]), (40, 1, []), (42, 0, [0.3]), (44, 7, [0.1, 0.2, 0.3]), (46, 0, [1e308, 0, 0])]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows[:0]) == []
    # One label alone has no negatives, one row alone no positives.
    assert mined(spark, [(i, 1, [0.1 * i, 1.0]) for i in range(6)]) == []
    assert mined(spark, rows[:1]) == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, i % 2, [1e5 + i / 256, 3e5 - i / 256, 2e6 + i / 256 * (i % 5)]) for i in range(24)]
    found = brute(rows, most=100)
    assert found and max(r[4] for r in found) > 2**53
    assert mined(spark, rows, most=100) == found


@pytest.mark.parametrize("seed", range(4))
def test_pruning_keeps_all_that_reaches_the_threshold(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(256 * rng.normal(size=(400, 8)) * rng.uniform(0.1, 2, (400, 1)))
    bucket, dropped = hard_negatives.Bucket(x), 0
    for anchor in np.floor(256 * rng.normal(size=(30, 8))):
        scores = x @ anchor
        for threshold in (-1, 0, *np.quantile(scores, [0.5, 0.9, 0.99, 1]), scores.max() * 2):
            kept = set(bucket.candidates(anchor, threshold).tolist())
            assert set(np.flatnonzero(scores >= threshold).tolist()) <= kept
            dropped += len(x) - len(kept)
    assert dropped
