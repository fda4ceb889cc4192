"""SetSketch near duplicates against all pairs of full sets, and the sketch against its theory."""

import random

import numpy as np
import pytest

from shoplens.llm import queries, set_sketch


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, least):
    """Sorted (doc_id, n, component, kept) from all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= least * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            groups[root(i)] = min(doc_id, groups.get(root(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = groups.get(root(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=str)


def found(df, least):
    return sorted((tuple(r) for r in set_sketch.near_duplicates(df, least=least).collect()), key=str)


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op12_set_sketch(spark, folder).collect()), key=str) == brute(rows, 85)


@pytest.mark.parametrize("least", [80, 95])
def test_dense_family_and_hot_places_equal_all_pairs(spark, monkeypatch, least):
    monkeypatch.setattr(set_sketch, "BLOCK_SETS", 16)
    # A family around one text, with edits of all sizes, so that links, near misses and chains occur.
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(160)]
    rows = []
    for i in range(140):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base)) for i in range(50)] + [(2000 + i, " ".join(f"y{i}_{k}" for k in range(60))) for i in range(40)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string"), least) == brute(rows, least)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs, 80) == brute(rows, 80)
    assert found(no_docs, 80) == []
    with pytest.raises(ValueError):
        set_sketch.near_duplicates(odd_docs, least=10)


def sketch_of(hashes):
    own = np.array(sorted(hashes), "uint64").view("int64")
    return set_sketch.registers(own, np.zeros(len(own), "int64"), 1)


def test_sketches_merge_and_estimate_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for similarity in (0.3, 0.6, 0.85, 0.95):
        for _ in range(20):
            pool = [int(x) for x in rng.integers(0, 1 << 63, 2000)]
            both = round(2000 * similarity)
            own = (2000 - both) // 2
            a, b = set(pool[: both + own]), set(pool[:both] + pool[both + own :])
            x, y = sketch_of(a), sketch_of(b)
            assert (np.maximum(x, y) == sketch_of(a | b)).all()
            estimate = set_sketch.estimates(x, y, np.array([float(len(a))]), np.array([float(len(b))]))[0]
            errors.append((estimate - similarity) / (similarity * (1 - similarity) / set_sketch.REGISTERS) ** 0.5)
    assert np.abs(errors).max() < 4 and abs(np.mean(errors)) < 0.5


def test_estimate_maximises_the_likelihood():
    rng = np.random.default_rng(4)
    pool = [int(x) for x in rng.integers(0, 1 << 63, 900)]
    a, b = pool[:700], pool[100:]
    x, y = sketch_of(a), sketch_of(b)
    u = len(a) / (len(a) + len(b))
    larger, smaller = (x > y).sum(), (x < y).sum()

    def likelihood(j):
        p, q = (-np.log1p(-z * (1 - 1 / set_sketch.BASE)) / np.log(set_sketch.BASE) for z in (u - (1 - u) * j, 1 - u - u * j))
        return larger * np.log(p) + smaller * np.log(q) + (set_sketch.REGISTERS - larger - smaller) * np.log(1 - p - q)

    grid = np.linspace(0.001, min(u / (1 - u), (1 - u) / u) - 0.001, 4000)
    best = grid[np.argmax([likelihood(j) for j in grid])]
    assert abs(best - set_sketch.estimates(x, y, np.array([700.0]), np.array([800.0]))[0]) < 0.001
