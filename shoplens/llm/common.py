"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import HandOver

# ASCII white space, as a Java and Python character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
HELD_OUT_FOLDS = 5
# Bytes of an Arrow batch; by rows alone, 10,000 long texts would travel at once.
BATCH_BYTES = 8 << 20
# Rows of a small table that one file takes.
FILE_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_of_stage: ContextVar[list[HandOver] | None] = ContextVar("of_stage", default=None)


@contextmanager
def stage_tables() -> Iterator[None]:
    """Removes at its end what :func:`written` has written since; results must be stored elsewhere by then."""
    opened: list[HandOver] = []
    before = _of_stage.set(opened)
    try:
        yield
    finally:
        _of_stage.reset(before)
        for store in opened:
            store.close()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: cuts the lineage for good. The table
    stays until the end of the surrounding :func:`stage_tables`, if there is one."""
    store, opened = HandOver(df.sparkSession), _of_stage.get()
    if opened is not None:
        opened.append(store)
    return store.put(name, df)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds what travels to and from Python at once by bytes, for good: results are lazy and run later."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def few(df: DataFrame, rows: int, per_file: int = FILE_ROWS) -> DataFrame:
    """``df``, known to have at most about ``rows`` rows, in as many partitions as these need: two per core at
    least, so that small tables are not a file per shuffle partition, and more as the rows grow."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_file)))


def words_of(text: Column) -> Column:
    """Words of a text as a JVM-side array; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+"), "")


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels no model may learn from (null ids are held out too)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(True))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts of an Arrow batch as UTF-8; null gives an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(batch.column(column).type) else pa.binary()
    return [x or b"" for x in batch.column(column).cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most_bytes`` of ``column`` (or one longer value)."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        first, total = 0, 0
        for i, n in enumerate(sizes):
            total += n or 0
            if total >= most_bytes:
                yield batch.slice(first, i + 1 - first)
                first, total = i + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)


def worker_cache(name: str) -> dict:
    """A dictionary that outlives the task in a reused Python worker; losing it costs time only. A
    worker holds one at a time, so that what one operator remembers does not add to the next one's."""
    holder = sys.modules.setdefault("_shoplens_worker_cache", types.ModuleType("_shoplens_worker_cache")).__dict__
    if holder.get("_owner") != name:
        holder.update(_owner=name, _values={})
    return holder["_values"]


def wide(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Partitions for ``rows`` rows, not fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_partition))
