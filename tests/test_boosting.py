"""The histogram learner against a plain leaf-by-leaf learner on the same rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import boosting
from shoplens.operators.boosting import Objective

SMALL = Objective(leaves=7, depth=4, l1=1.5, l2=2.0, column_share=1.0, least_rows=5, rate=0.3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for _ in range(900):
        a, b, c, d = rng.random(), rng.choice([0, 0, 0, 1, 2, 5]), rng.gauss(0, 1), rng.randrange(3)
        out.append((a, b, c, d, int(a * 2 + (b > 1) + 0.3 * c * (d == 1) + rng.random() > 2)))
    return out


@pytest.fixture(scope="module")
def sample(spark, rows):
    return spark.createDataFrame(rows, "a double, b int, c double, d int, flag int").repartition(4)


FEATURES = ["a", "b", "c", "d"]


def soft(g, l1):
    return np.sign(g) * max(abs(g) - l1, 0)


def plain_tree(x, g, h, edges, o):
    """Sequential best-first growth: split the leaf of the largest gain until the limit."""

    def quality(at):
        return soft(g[at].sum(), o.l1) ** 2 / (h[at].sum() + o.l2)

    def best(at, depth):
        found = (0.0, None)
        if depth < o.depth:
            for f in range(x.shape[1]):
                for t in edges[f]:
                    left, right = at[x[at, f] <= t], at[x[at, f] > t]
                    if min(len(left), len(right)) >= o.least_rows and min(h[left].sum(), h[right].sum()) >= o.least_hessian:
                        gain = quality(left) + quality(right) - quality(at)
                        if gain > found[0] + 1e-9:
                            found = (gain, (f, t, left, right))
        return found

    leaves, splits = [(np.arange(len(x)), 0)], []
    scored = [best(*leaves[0])]
    while len(leaves) < o.leaves and max(s[0] for s in scored) > 0:
        i = int(np.argmax([s[0] for s in scored]))
        gain, (f, t, left, right) = scored.pop(i)
        _, depth = leaves.pop(i)
        splits.append((f, round(float(t), 9)))
        for side in (left, right):
            leaves.append((side, depth + 1))
            scored.append(best(side, depth + 1))
    margin = np.zeros(len(x))
    for at, _ in leaves:
        margin[at] = -o.rate * soft(g[at].sum(), o.l1) / (h[at].sum() + o.l2)
    return sorted(splits), margin


def test_trees_equal_sequential_leaf_wise_growth(sample, rows):
    edges = boosting.bin_edges(sample, FEATURES, bins=16)
    model = boosting.train(sample, FEATURES, 4, objective=SMALL, edges=edges)
    data = np.array(rows, "float64")
    x, y = data[:, :4], data[:, 4]
    margin = np.full(len(x), model.start)
    for tree in model.trees:
        chance = 1 / (1 + np.exp(-margin))
        splits, step = plain_tree(x, chance - y, chance * (1 - chance), edges, SMALL)
        inner = np.flatnonzero(tree.left >= 0)
        assert sorted((int(tree.feature[i]), round(float(tree.threshold[i]), 9)) for i in inner) == splits
        assert len(inner) <= SMALL.leaves - 1
        assert np.allclose(tree.of_values(x), step, atol=1e-5)
        margin += step


def test_penalties_limits_and_column_share_are_honoured(sample):
    free = boosting.train(sample, FEATURES, 1, objective=Objective(leaves=50, depth=8, l1=0, l2=0, column_share=1.0, least_rows=1)).trees[0]
    assert (free.left < 0).sum() == 50
    held = boosting.train(sample, FEATURES, 1, objective=Objective(leaves=50, depth=2, l1=0, l2=0, column_share=1.0)).trees[0]
    assert (held.left < 0).sum() <= 4
    strict = boosting.train(sample, FEATURES, 1, objective=Objective(l1=1e6, column_share=1.0)).trees[0]
    assert len(strict.left) == 1 and strict.value[0] == 0
    one = boosting.train(sample, FEATURES, 6, objective=Objective(l1=0, column_share=0.25, least_rows=5)).trees
    used = [set(t.feature[t.left >= 0].tolist()) for t in one]
    assert all(len(u) <= 1 for u in used) and len(set().union(*used)) > 1
    with pytest.raises(ValueError):
        Objective(leaves=0)


def test_trees_do_not_depend_on_partitions_or_rewrites(sample, monkeypatch):
    models = [boosting.train(sample.repartition(n), FEATURES, 5, objective=SMALL) for n in (1, 7)]
    monkeypatch.setattr(boosting, "KEEP", 2)
    models.append(boosting.train(sample, FEATURES, 5, objective=SMALL))
    for other in models[1:]:
        assert other.start == models[0].start
        for x, y in zip(models[0].trees, other.trees, strict=True):
            assert all(np.array_equal(a, b) for a, b in zip(vars(x).values(), vars(y).values(), strict=True))


def test_staged_probabilities_equal_shorter_models(sample):
    longest = boosting.train(sample, FEATURES, 6, objective=SMALL)
    both = boosting.staged_probabilities(longest, sample.withColumn("id", F.monotonically_increasing_id()), (0, 3, 6, 9))
    assert both.columns == ["flag", "id", "probability_0", "probability_1", "probability_2", "probability_3"]
    got = both.orderBy("id").collect()
    for i, n in enumerate((0, 3, 6, 6)):
        short = boosting.Boosted(longest.features, longest.start, boosting.train(sample, FEATURES, n, objective=SMALL).trees)
        alone = boosting.staged_probabilities(short, sample.withColumn("id", F.monotonically_increasing_id()), (n,)).orderBy("id").collect()
        assert max(abs(r[f"probability_{i}"] - s["probability_0"]) for r, s in zip(got, alone, strict=True)) < 1e-12


def test_odd_samples(spark):
    schema = "a double, b double, flag int"
    nulls = spark.createDataFrame([(None, float(i), i % 2) for i in range(60)] + [(float("nan"), 1.0, 1)] * 30, schema)
    model = boosting.train(nulls, ["a", "b"], 2, objective=SMALL)
    assert boosting.staged_probabilities(model, nulls, (2,)).where("probability_0 between 0 and 1").count() == 90
    # One label alone, no rows, constant features: no trees, the share of the label for all.
    for df in (nulls.where("flag = 1"), nulls.limit(0), nulls.withColumn("b", F.lit(1.0))):
        model = boosting.train(df, ["a", "b"], 2, objective=SMALL)
        assert not model.trees
        assert boosting.staged_probabilities(model, df, (1, 2)).count() == df.count()
