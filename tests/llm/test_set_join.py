"""Near duplicates by exact similarity."""

from collections import Counter

import numpy as np
import pytest

from shoplens.llm import set_join
from shoplens.llm.common import stage_tables, written
from shoplens.session import HandOver


def sets_of(rows, shingle=5):
    split = [(t or "").lower().split() for _, t in rows]
    return [{" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set() for w in split]


def kept_by_brute_force(rows, least=0.8):
    sets, root = sets_of(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            together = len(sets[i] | sets[j])
            if root[i] != root[j] and (len(sets[i] & sets[j]) >= least * together - 1e-9 if together else True):
                root = [root[j] if x == root[i] else x for x in root]
    return {min(d for (d, _), x in zip(rows, root, strict=True) if x == r) for r in set(root)}


def edited(rng, text, edits):
    words = list(text)
    for at in rng.choice(len(words) - 10, edits, replace=False) + 5:
        words[at] = f"edit{rng.integers(1 << 40)}"
    return words


def test_exact_join_equals_brute_force(spark):
    rng, words, texts = np.random.default_rng(5), [f"w{i}" for i in range(5000)], []
    for edits in [6, 7, 8, 8, 8, 9, 9, 10, 14, 20] * 6:  # similarity 0.86 to below 0.6, many about 0.8
        text = rng.choice(words, 400).tolist()
        texts += [text, edited(rng, text, edits)]
    template = rng.choice(words, 120).tolist()
    texts += [edited(rng, template, 4) for _ in range(60)]  # alike below 0.8
    center = rng.choice(words, 300).tolist()
    texts += [edited(rng, center, int(rng.integers(1, 5))) for _ in range(90)]  # a large meeting place
    passage = rng.choice(words, 80).tolist()
    texts += [rng.choice(words, 40).tolist() + passage for _ in range(90)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, ""), (901, None), (902, "a b"), (903, "a b"), (904, "A  b"), (905, "a c")]
    docs = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "doc_id bigint, text string").repartition(3)
    kept = set_join.one_per_class(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(kept_by_brute_force(rows))


def test_classes_of_documents_equal_brute_force(documents, odd_docs, no_docs, monkeypatch):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    for pairwise in (set_join.PAIRWISE, 1):  # with 1 every place counts as large
        monkeypatch.setattr(set_join, "PAIRWISE", pairwise)
        kept = set_join.one_per_class(documents)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(kept_by_brute_force(rows))
    odd = set_join.one_per_class(odd_docs)
    assert odd.columns == odd_docs.columns and Counter(r[0] for r in odd.select("doc_id").collect())[1] == 2
    assert set_join.one_per_class(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 6, 99, 100, 101])
def test_prefix_leaves_out_one_less_than_a_similar_set_must_share(n):
    hashes = np.arange(n, dtype="int64")
    kept, _ = set_join.prefixes(hashes, np.zeros(n, "int64"), 1, 0.8, (hashes[:0], hashes[:0]))
    assert n - len(kept) == -(-4 * n // 5) - 1


def test_bit_maps_never_differ_in_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(2)
    for n, m, shared in [(0, 0, 0), (0, 1, 0), (1, 1, 1), (60, 70, 58), (64, 65, 64), (400, 500, 400), (500, 520, 100), (1000, 1100, 990), (3, 5000, 3)]:
        found = np.unique(rng.integers(-(2**63), 2**63, n + m - shared, dtype="int64"))
        rng.shuffle(found)
        x, y = np.sort(found[:n]), np.sort(found[n - shared :])
        differ = set_join.differing(set_join.flips(x), set_join.flips(y))
        assert differ <= n + m - 2 * shared and differ == set_join.differing(set_join.flips(y), set_join.flips(x))


def test_tables_of_a_stage_go_with_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shoplens.session.shared_folder", lambda spark: str(tmp_path))
    kept = written(spark.range(3), "outside")
    with stage_tables():
        result = HandOver(spark).put("result", written(spark.range(5), "inside"))
        with stage_tables():
            written(spark.range(2), "nested")
        assert len(list(tmp_path.iterdir())) == 3
    assert sorted(p.name for f in tmp_path.iterdir() for p in f.iterdir() if not p.name.startswith(".")) == ["outside", "result"]
    assert (kept.count(), result.count()) == (3, 5)
    with pytest.raises(ValueError, match="stop"), stage_tables():
        written(spark.range(2), "failed")
        raise ValueError("stop")
    assert len(list(tmp_path.iterdir())) == 2
