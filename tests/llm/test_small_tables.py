"""Memory and files of the pipeline: batches bounded by bytes, small tables in few files."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoplens.llm import graph, set_join
from shoplens.llm.common import BATCH_BYTES
from shoplens.session import HandOver

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def files(monkeypatch):
    """(table, number of its files) of what is written meanwhile."""
    found, put = [], HandOver.put

    def counted(self, name, df, partition_by=()):
        table = put(self, name, df, partition_by)
        found.append((name, sum(x.endswith(".parquet") for x in os.listdir(self.path(name).removeprefix("file:")))))
        return table

    monkeypatch.setattr(HandOver, "put", counted)
    return found


def test_stages_bound_batches_by_bytes(spark):
    def weigh(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    corpus_pipeline.STAGES[3][1](spark, documents, SMALL)
    long = spark.range(0, 48, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sizes = [r["n"] for r in long.mapInArrow(weigh, "n bigint").collect()]
    assert max(sizes) < 2 * BATCH_BYTES and sum(sizes) >= 48 << 20


def test_classes_of_few_edges_take_few_files(spark, many_partitions, files):
    edges = spark.range(306).select((F.col("id") * 7 % 307).alias("a"), ((F.col("id") + 1) * 7 % 307).alias("b"))
    roots = {r["node"]: r["root"] for r in graph.components(edges, most_edges=306).collect()}
    assert roots == dict.fromkeys(range(307), 0)
    most = 2 * spark.sparkContext.defaultParallelism
    assert files and all(n <= most for name, n in files if name == "edges")


def test_comparing_few_sets_takes_few_files(spark, many_partitions, files):
    texts = [" ".join(f"t{g}w{i}" for i in range(60)) for g in range(100)]
    rows = [(2 * g + k, t + " end" * k) for g, t in enumerate(texts) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    kept = set_join.one_per_class(docs).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == [2 * g for g in range(100)]
    most = 2 * spark.sparkContext.defaultParallelism
    assert {"slots", "sets", "compared", "edges"} <= {name for name, _ in files}
    assert all(n <= most for name, n in files if name in ("slots", "named", "sets", "compared", "edges"))
