"""Merkle manifest against a direct computation, and its defined results."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shoplens.llm import merkle, queries

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, n_chars):
    fields = [None if x is None else str(x) for x in (r["doc_id"], r["source"], r["lang"], n_chars, r["text"])]
    return h(*("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))


def tree(leaves, arity):
    """Root, and per leaf the (before, after) digests of each level."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place - place % arity
            paths[i].append(("".join(level[first:place]), "".join(level[place + 1 : first + arity])))
        level = [h(*level[i : i + arity]) for i in range(0, len(level), arity)]
        at = [place // arity for place in at]
    return level[0] if level else None, paths


def brute(rows, arity):
    """Sorted (doc_id, leaf, subroot, root, proof) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    low = {}
    for name in names:
        own = sorted((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["n_chars"])) for r in groups[name])
        low[name] = (own, *tree([x[2] for x in own], arity))
    root, high = tree([low[name][1] for name in names], arity)
    found = []
    for name, above in zip(names, high, strict=True):
        own, subroot, paths = low[name]
        for (there, doc_id, leaf), path in zip(own, paths, strict=True):
            found.append((doc_id if there else None, leaf, subroot, root, h(*(b + a for b, a in path + above))))
    return sorted(found, key=str)


def listed(df, arity):
    rows = df.select("doc_id", "lang", merkle.document_leaf().alias("leaf"))
    full = merkle.manifest(rows, "lang", ["doc_id"], arity=arity)
    back = full.withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).withColumn("proof", merkle.proof(F.col("path")))
    found = back.collect()
    assert all(r["again"] == r["root"] for r in found)
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found), key=str)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_equals_brute_force_on_odd_rows(spark, arity):
    rows = [(i, f"text {i}", "en", None, i) for i in range(11)]
    rows += [(i, "ü" * i, "日", "s", None) for i in range(4)] + [(5, None, None, None, None), (None, "", None, "-", 3)]
    rows += [(7, "same", "fr", "s", 1)] * 3 + [(7, "same id", "fr", "s", 1), (9, "alone", "zz", "s", 2), (1, "empty name", "", "s", 2)]
    df = spark.createDataFrame(rows, ROWS)
    assert listed(df, arity) == brute(df.collect(), arity)


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(1, "a", "en", "s", 1)], ROWS)
    leaf = leaf_of(one.first(), 1)
    assert listed(one, 2) == [(1, leaf, leaf, leaf, h(""))]
    assert listed(one.limit(0), 2) == []
    with pytest.raises(ValueError):
        merkle.manifest(one.withColumn("leaf", F.lit("00")), "lang", ["doc_id"], arity=1)


def test_long_texts_and_clashing_columns(spark, odd_docs):
    rows = odd_docs.selectExpr("doc_id", "source", "sha2(coalesce(text, ''), 256) as leaf", "n_words as root", "'x' as path", "score as subroot", "copy")
    found = merkle.manifest(rows, "source", ["doc_id"])
    assert sorted(found.columns) == sorted(["doc_id", "source", "leaf", "root", "path", "subroot", "copy"])
    roots = found.select("root", F.length("root").alias("n")).distinct().collect()
    assert len(roots) == 1 and roots[0]["n"] == 64 and found.count() == odd_docs.count()


def test_rows_do_not_depend_on_partitioning(spark, documents):
    rows = documents.select("doc_id", "lang", merkle.document_leaf().alias("leaf"))
    few, many = (merkle.manifest(rows.repartition(n), "lang", ["doc_id"]).first()["root"] for n in (1, 13))
    assert few == many


def test_query_finds_exactly_what_was_tampered_with(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op11_merkle(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and docs[r["doc_id"]]["n_chars"] is not None
        assert r["verified"] is not hit
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in found), key=str) == brute(docs.values(), 2)
