"""Hand-over tables that a later run finds again."""

from __future__ import annotations

import hashlib
import json
import os
import re
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import HandOver, shared_folder

_PLAN_TEXT = threading.Lock()
_WIDTH = "spark.sql.debug.maxToStringFields"


def plan_text(df: DataFrame) -> str:
    """The analysed plan in full, with expression numbers by first appearance, so that sessions agree."""
    conf = df.sparkSession.conf
    with _PLAN_TEXT:
        before = conf.get(_WIDTH)
        conf.set(_WIDTH, str(1_000_000))
        try:
            text = df._jdf.queryExecution().analyzed().toString()
        finally:
            conf.set(_WIDTH, before)
    seen: dict[str, str] = {}
    return re.sub(r"#\d+", lambda m: seen.setdefault(m.group(), f"#{len(seen)}"), re.sub(r"plan_id=\d+", "", text))


def inputs_state(df: DataFrame) -> list:
    """Number of files that ``df`` reads, and a sum over their paths, sizes and times, taken by a Spark job."""
    files = df.inputFiles()
    if not files:
        return [0, 0]
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", F.col("modificationTime").cast("double").alias("t"))
    state = listed.agg(F.count("*").alias("n"), F.sum(F.xxhash64("path", "length", "t").cast("decimal(38,0)")).alias("s")).first()
    return [state["n"], str(state["s"])]


class ResumableStore(HandOver):
    """Hand-over tables of a named run, which a later run under the same name reads instead of computing.

    A table is known by a fingerprint of its plan, of the files the plan reads (paths, sizes, times), of
    ``settings`` and of the Spark version; anything else is written anew. A table counts only when its manifest entry
    exists, which is created after the data: what a killed run left half written is never read. Each
    store writes below its own ``owner``, so that runs at the same time do not meet; the first manifest entry wins.

    Rows that were made in a session, and the code of Python functions, are no part of a plan's text: name their
    version in ``settings``. The tables stay until :meth:`close`, also after leaving a ``with`` block.
    """

    def __init__(self, spark: SparkSession, run: str, settings: object = None, folder: str | None = None) -> None:
        super().__init__(spark, folder)
        self.folder = os.path.join(folder or shared_folder(spark), f"run-{run}")
        self.owner = uuid.uuid4().hex
        self.settings = repr(settings)
        self.reused: list[str] = []

    def __exit__(self, *error) -> None:
        """Tables stay for the next run."""

    def fingerprint(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        parts = [name, list(partition_by), self.settings, self.spark.version, df.schema.json(), plan_text(df), inputs_state(df)]
        return hashlib.sha256(json.dumps(parts).encode()).hexdigest()

    def put(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """The table of this fingerprint: read if it is complete, else written once."""
        mark = self.fingerprint(name, df, partition_by)
        entry = f"{self.folder}/manifest/{name}-{mark}.json"
        found = self._entry(entry)
        if found is None:
            path = f"{self.folder}/{self.owner}/{name}-{mark}"
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            found = self._commit(entry, {"path": path, "owner": self.owner, "fingerprint": mark})
        else:
            self.reused.append(name)
        return self.spark.read.schema(df.schema).parquet(found["path"])

    def _hadoop(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entry(self, path: str) -> dict | None:
        """A manifest entry; None if there is none or its writing was cut off."""
        target, files = self._hadoop(path)
        if not files.exists(target):
            return None
        lines = self.spark.read.text(path, wholetext=True).collect()
        try:
            return json.loads(lines[0]["value"]) if lines else None
        except ValueError:
            return None

    def _commit(self, path: str, entry: dict) -> dict:
        """Publish an entry under its name by a rename, unless another run was first; the entry that holds."""
        own, files = self._hadoop(f"{path}.{self.owner}")
        out = files.create(own, True)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        if self._entry(path) is None:
            target, _ = self._hadoop(path)
            files.delete(target, False)
            files.rename(own, target)
        else:
            files.delete(own, False)
        return self._entry(path) or entry
