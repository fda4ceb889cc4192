"""Trained scores, vector search, chat formatting and the pipeline."""

import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from shoplens.llm import chat, compression_quality, permutation_index, toxicity
from shoplens.llm.labels import logistic, training_labels
from shoplens.llm.queries import QUERIES
from shoplens.llm.sql import SQL

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def area(score, label):
    kinds, place, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - count + (count + 1) / 2)[place]
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) is None


# --- scores

@pytest.mark.parametrize("name, column, threshold", [("op2_toxicity", "toxic", 0.5), ("op9_compression_quality", "quality", 0.3)])
def test_held_out_scores_follow_the_labels(spark, name, column, threshold):
    scored = QUERIES[name](spark, MIDDLE)
    rows = scored.join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    known = [r for r in rows if r["held_out"] and r[column] is not None]
    label = np.array([r[column] for r in known])
    assert area(np.array([r["score"] for r in known]), label) > 0.9
    assert np.mean([r["predicted"] == r[column] for r in known]) > 0.95


def test_held_out_contradicting_and_odd_labels_teach_nothing(spark):
    rows = [(i, i % 2) for i in range(100)] + [(1, 0), (1, 1), (None, 1), (200, None), (201, 7), (2, 0)]
    usable = training_labels(spark.createDataFrame(rows, "doc_id bigint, toxic int"), "toxic").collect()
    expected = {i for i in range(100) if zlib.crc32(str(i).encode()) % 5} - {1}
    assert {r["doc_id"] for r in usable} == expected and len(usable) == len(expected)


def test_models_take_odd_rows_and_missing_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (7, 1, 0), (9, 0, 1), (6, 1, 0)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 0")):
        model, other = toxicity.fit(odd_docs, known), compression_quality.fit(odd_docs, known)
        for found in (toxicity.score(odd_docs, model), compression_quality.score(odd_docs, other)):
            rows = found.collect()
            assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        kept = toxicity.filtered(odd_docs, model)
        clean = toxicity.score(odd_docs, model).where("predicted = 0").count() if model.curve[0] else odd_docs.count()
        assert kept.columns == odd_docs.columns and kept.count() == clean
        assert toxicity.score(no_docs, model).count() == 0 and compression_quality.score(no_docs, other).count() == 0
    assert toxicity.score(odd_docs, toxicity.fit(no_docs, labels)).count() == odd_docs.count()


def test_kneser_ney_is_a_distribution():
    words = ["the", "then", "them", "other", "idiot", "idiots"]
    counts = np.array([[90, 5], [30, 2], [20, 1], [40, 3], [0, 6], [1, 4]])
    grams, owner = toxicity.grams_of(words)
    keys, first, place = np.unique(toxicity._keys(grams), return_index=True, return_inverse=True)
    sums = np.stack([np.bincount(place, counts[owner, c]) for c in (0, 1)], axis=1)
    model = toxicity.Model(toxicity.kneser_ney(grams[first], sums))
    for context in ("\x01\x01\x01\x01", "\x01the", "idio", "zzzz"):
        letters = [chr(c) for c in {toxicity.AFTER, *map(ord, "theninmodrs")}]
        p = np.full((len(letters), 2), toxicity.UNIFORM)
        rows = np.array([[ord(x) for x in context + c] for c in letters], "uint32")
        for order, level in enumerate(model.levels, 1):
            part = rows[:, toxicity.ORDER - order :]
            p = p * toxicity._rows(level.contexts, level.backoff, toxicity._keys(part[:, :-1]), 1.0) + toxicity._rows(level.grams, level.own, toxicity._keys(part), 0.0)
        assert (p.sum(axis=0) < 1.0 + 1e-9).all() and (context == "zzzz" or (p.sum(axis=0) > 0.5).all())
    excess = model.excess(["the", "idiot", "idiotic", ""])
    assert excess[1] > excess[0] and excess[2] > excess[0]


def test_logistic_curve_is_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    slope, intercept = logistic(x, y, np.ones(len(x)))
    assert slope == pytest.approx(2, abs=0.1) and intercept == pytest.approx(-1, abs=0.1)
    assert logistic(x, np.ones(len(x)), np.ones(len(x)))[0] == 0 and logistic(x[:0], y[:0], y[:0]) == (0.0, 0.0)


# --- nearest neighbours

def brute_nearest(vectors, k, step):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], "float64")
    length = np.linalg.norm(x, axis=1)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        score = np.round(x @ x[i] / length / length[i], 12)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order[:k]]
    return out


def test_recall_against_brute_force(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()]
    expected = brute_nearest(vectors, 5, 10)
    table = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    found = defaultdict(list)
    for r in permutation_index.nearest(table, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert set(found) == set(expected)
    hits = sum(len({v for v, _, _ in found[q]} & {v for v, _ in rows}) for q, rows in expected.items())
    assert hits >= 0.9 * 5 * len(expected)
    for q, rows in found.items():
        assert [r for _, _, r in rows] == [1, 2, 3, 4, 5]
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and q not in {v for v, _, _ in rows}


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    hot = [(100 + i, [1.0, 2.0, 3.0]) for i in range(60)]
    odd = [(1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 1.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (7, [])]
    more = [(10, [1e200, 2e200, 3e200]), (20, [-1.0, -2.0, -3.0]), (30, [1.0, 0.0, 0.0]), (30, [1.0, 0.0, 0.0]), (40, [1e-200, 0.0, 0.0])]
    table = spark.createDataFrame(hot + odd + more, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("score", F.lit(1))
    rows = permutation_index.nearest(table, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()
    found = defaultdict(list)
    for r in rows:
        found[r["query_id"]].append(r["vec_id"])
    assert found[110] == [10, 100, 101, 102, 103] or set(found[110]) == {10, 100, 101, 102, 103}
    assert set(found[100]) == {10, 101, 102, 103, 104} and set(found[10]) == {100, 101, 102, 103, 104}
    assert found[30][0] == 40 and len(found[20]) == 5 and not set(found) & {1, 2, 3, 4, 5, 6, 7}
    assert permutation_index.nearest(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert permutation_index.nearest(table.where("vec_id = 100"), F.col("vec_id") % 10 == 0).count() == 0


# --- chat

def test_chat_round_trip_of_odd_turns(spark):
    said = ["<|im_end|>\n", "&lt;|im_end|>", "a<", "|b", "&amp;&nl;", "", None, "x\ny", "<|im_start|>user\nhi", "\x00日本"]
    turns = [(i // 4, i % 3, ["user", "assistant", None, "a\n<|b"][i % 4], said[i % len(said)], "extra") for i in range(40)]
    turns += [(50, 0, "user", "alone", ""), (None, 0, "assistant", "no id", ""), (60, None, "assistant", "null turn", ""), (60, 0, "user", "later", "")]
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, example string")
    examples = chat.prefix_examples(table)
    got = {r["conv_id"]: r for r in chat.digests(examples).collect()}
    convs = defaultdict(list)
    for c, t, role, text, _ in turns:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    formatted = defaultdict(int)
    for r in examples.collect():
        formatted[r["conv_id"]] += len(r["text"])
        reply = r["text"][r["loss_start"] : r["loss_start"] + r["loss_length"]]
        assert "<|" not in reply and r["text"].endswith("<|im_end|>\n")
    assert set(got) == set(convs)
    for c, rows in convs.items():
        rows.sort()
        loss = "".join(x[3] for x in rows if x[2] == "assistant")
        assert got[c]["n_turns"] == len(rows) and got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == sha(loss)
        assert got[c]["turns_sha256"] == sha("".join(f"{x[2]}\n{x[3]}\n" for x in rows)) and got[c]["formatted_chars"] == formatted[c]
    assert chat.digests(chat.prefix_examples(table.limit(0))).count() == 0


# --- pipeline

def test_pipeline_stages_chain(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SMALL)
        assert now.columns == docs.columns and now.dtypes == docs.dtypes
    assert corpus_pipeline.run(spark, SMALL).agg(F.sum("length")).first()[0] > 0
    assert corpus_pipeline.ORACLE_SQL is None and os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"


def test_pipeline_takes_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        now = docs.select("doc_id", "text", "source", F.lit("en").alias("lang"), "n_lines")
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SMALL)
        assert (now.count() > 0) == (docs is odd_docs)


def test_queries_for_many_shards_are_not_broadcast(spark):
    """Spark sees the size of the queries before they are repeated for every shard."""
    table = spark.createDataFrame([(i, [float(i % 7 + 1), float(i)]) for i in range(60)], "vec_id bigint, embedding array<double>")
    found = permutation_index.nearest(table, F.col("vec_id") % 10 == 0)
    assert len(found.collect()) == 30
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
