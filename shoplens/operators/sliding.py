"""Trailing counts and distinct counts carried from day to day, for runs that add one anchor at a time.

The state of a day is one row per key with its counts of all windows. The next day adds its own actions
and takes off, for each window, the one day that leaves it: a daily run reads the new day, the roll-ups of
as many days as there are windows, and the state of the keys concerned, not the log of the longest window.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplens.functions.exprs import known_keys, sum_where
from shoplens.operators.breadth import BREADTH_TYPES, breadth_name
from shoplens.operators.trailing import count_name
from shoplens.session import HandOver
from shoplens.settings import ACTION_TYPES, WINDOWS

# Parts of a state that are rewritten on their own; also the most that the driver lists of it.
BUCKETS = 64


class VersionedRows:
    """A table in ``buckets`` parts by a hash of ``by``; a new day replaces some parts, the others stay as they are.

    Parts lie in folders by the day that wrote them, and a manifest per day names the day of each part. It is put
    in place by a rename when all parts are written: what a killed run left is never read, and its day can be run
    again. Parts that a day replaced are removed two days later, so that rows read lazily stay valid for a day.
    Another ``settings`` than the table was made with is an error.
    """

    def __init__(self, spark: SparkSession, folder: str, by: list[str], settings: object, buckets: int = BUCKETS) -> None:
        self.spark, self.folder, self.by, self.buckets = spark, folder, by, buckets
        self.settings = repr((by, buckets, settings))

    def _files(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        target, files = self._files(path)
        return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []

    def exists(self, path: str) -> bool:
        target, files = self._files(path)
        return files.exists(target)

    def remove(self, path: str) -> None:
        target, files = self._files(path)
        files.delete(target, True)

    def last(self) -> date | None:
        """The last day whose rows are complete."""
        days = [n[: -len(".json")] for n in self._names(f"{self.folder}/manifest") if n.endswith(".json")]
        return date.fromisoformat(max(days)) if days else None

    def _manifest(self, day: date) -> dict:
        found = json.loads(self.spark.read.text(f"{self.folder}/manifest/{day}.json", wholetext=True).first()["value"])
        if found["settings"] != self.settings:
            raise ValueError(f"{self.folder} was made with {found['settings']}, not {self.settings}")
        return found

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def rows(self, only: list[int] | None = None) -> DataFrame:
        """Rows of the last day, or of some of its parts."""
        found = self._manifest(self.last())
        schema = StructType.fromJson(found["schema"])
        parts = {b: d for b, d in found["parts"].items() if only is None or int(b) in only}
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/parts/{d}/bucket={b}" for b, d in parts.items()])

    def publish(self, day: date, rows: DataFrame, replaced: list[int]) -> None:
        """Make ``rows`` the content of the ``replaced`` parts from ``day`` on."""
        before = self.last()
        parts = self._manifest(before)["parts"] if before else {}
        path = f"{self.folder}/parts/{day}"
        rows.withColumn("bucket", self.bucket()).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)
        filled = [n[len("bucket="):] for n in self._names(path) if n.startswith("bucket=")]
        kept = {b: d for b, d in parts.items() if int(b) not in replaced}
        entry = {"settings": self.settings, "schema": rows.schema.jsonValue(), "parts": {**kept, **dict.fromkeys(filled, str(day))}}
        draft, files = self._files(f"{self.folder}/manifest/{day}.{uuid.uuid4().hex}")
        out = files.create(draft, True)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        if not files.rename(draft, self._files(f"{self.folder}/manifest/{day}.json")[0]):
            raise RuntimeError(f"{day} of {self.folder} is there already")
        self._forget(before, parts)

    def _forget(self, before: date | None, parts: dict[str, str]) -> None:
        """Remove manifests older than ``before`` and the parts that only they name."""
        names = [n for n in self._names(f"{self.folder}/manifest") if n.endswith(".json")]
        for name in names:
            old = date.fromisoformat(name[: -len(".json")])
            if before and old < before:
                for b, d in self._manifest(old)["parts"].items():
                    if parts.get(b) != d:
                        self.remove(f"{self.folder}/parts/{d}/bucket={b}")
                self.remove(f"{self.folder}/manifest/{name}")


class SlidingCounts:
    """Actions of each type per key in every window, as of the last day added.

    The same rows as :func:`shoplens.operators.trailing.trailing_counts` with that day as anchor: a key has a row
    while an action lies in the longest window; null keys have none. ``log`` may hold other days, only those
    concerned are read. A day that was cut off is added again with the same rows; a day without rows only takes
    off what leaves. Actions that come late for a day already added are not seen.
    """

    def __init__(
        self, spark: SparkSession, folder: str, keys: list[str], windows: tuple[int, ...] = WINDOWS,
        types: tuple[int, ...] = ACTION_TYPES, buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.keys, self.windows, self.types = spark, keys, windows, types
        self.days = f"{folder}/days"
        self.state = VersionedRows(spark, f"{folder}/state", keys, (windows, types), buckets)
        self.cells = {count_name(keys, t, n): (t, n) for n in windows for t in types}

    def _daily(self, log: DataFrame) -> DataFrame:
        rows = known_keys(log.where(F.col("type").isin(*self.types)), self.keys)
        return rows.groupBy(*self.keys, "action_date").agg(*[sum_where(F.col("type") == t).alias(f"n{t}") for t in self.types])

    def start(self, log: DataFrame, day: date) -> None:
        """The state of a first day, from the log of its longest window."""
        if self.state.last():
            raise ValueError(f"the state of {self.state.last()} is there already")
        first = day - timedelta(days=max(self.windows) - 1)
        window = self._daily(log.where(F.col("action_date").between(F.lit(first), F.lit(day))))
        window.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("action_date").parquet(self.days)
        daily = self.spark.read.schema(window.schema).parquet(self.days)
        age = f"datediff(date'{day}', action_date)"
        sums = [F.expr(f"sum(if({age} < {n}, n{t}, 0))").alias(c) for c, (t, n) in self.cells.items()]
        placed = daily.repartition(self.state.buckets, self.state.bucket())
        self.state.publish(day, placed.groupBy(*self.keys).agg(*sums), list(range(self.state.buckets)))

    def advance(self, log: DataFrame) -> date:
        """Add the day after the last one; returns it."""
        before = self.state.last()
        if before is None:
            raise ValueError("start with a first day")
        day = before + timedelta(days=1)
        daily = self._daily(log.where(F.col("action_date") == F.lit(day)))
        daily.drop("action_date").write.mode("overwrite").parquet(f"{self.days}/action_date={day}")
        with HandOver(self.spark) as store:
            changes = store.put("changes", self._changes(day, daily.schema))
            touched = [r["b"] for r in changes.select(self.state.bucket().alias("b")).distinct().collect()]
            # Sorted into parts before the sum: the same exchange serves the sum and the writing.
            both = self.state.rows(touched).unionByName(changes).repartition(max(1, len(touched)), self.state.bucket())
            sums = both.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.cells])
            longest = " + ".join(f"`{c}`" for c, (_, n) in self.cells.items() if n == max(self.windows))
            self.state.publish(day, sums.where(f"{longest} > 0"), touched)
        self.state.remove(f"{self.days}/action_date={day - timedelta(days=max(self.windows))}")
        return day

    def _changes(self, day: date, schema: StructType) -> DataFrame:
        """What the new day adds and each window's leaving day takes off, per key: one folder per day is read."""
        wanted = [day, *[day - timedelta(days=n) for n in sorted(set(self.windows))]]
        paths = [p for p in (f"{self.days}/action_date={d}" for d in wanted) if self.state.exists(p)]
        rows = self.spark.read.schema(schema).option("basePath", self.days).parquet(*paths)
        return rows.groupBy(*self.keys).agg(*[
            F.expr(
                f"sum(case action_date when date'{day}' then n{t} when date'{day - timedelta(days=n)}' then -n{t} else 0 end)"
            ).alias(c) for c, (t, n) in self.cells.items()
        ])

    def counts(self) -> DataFrame:
        """(keys, anchor_date, counts) of the last day; valid until two further days are added."""
        return self.state.rows().select(*self.keys, F.lit(self.state.last()).alias("anchor_date"), *self.cells)


class SlidingDistinct:
    """Distinct values per key, type and window, as of the last day added.

    The same rows as :func:`shoplens.operators.breadth.trailing_distinct` with that day as anchor. The state is one row
    per (keys, value) in the longest window with its latest day by type, spread over all of its columns, so
    that a key with a third of the log is no hot spot. A pair is in a window if its latest day is; a daily run merges
    the pairs of the new day into the state and counts per key, without any earlier day of the log.
    """

    def __init__(
        self, spark: SparkSession, folder: str, keys: list[str], values: list[str], windows: tuple[int, ...] = WINDOWS,
        types: tuple[int, ...] = BREADTH_TYPES, buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.keys, self.values, self.windows, self.types = spark, keys, values, windows, types
        self.pair = [*keys, "what", "value"]
        self.state = VersionedRows(spark, f"{folder}/pairs", self.pair, (values, windows, types), buckets)
        self.latest = {None: "latest", **{t: f"latest{t}" for t in types}}

    def _pairs(self, log: DataFrame, first: date, day: date) -> DataFrame:
        """Latest day of each pair by type, for the rows of some days; null values are kept as a pair."""
        rows = known_keys(log.where(F.col("action_date").between(F.lit(first), F.lit(day))), self.keys)
        kind = dict(rows.dtypes)
        common = "string" if any(kind[v] == "string" for v in self.values) else "bigint"
        items = F.array(*[F.struct(F.lit(v).alias("what"), F.col(v).cast(common).alias("value")) for v in self.values])
        return rows.select(*self.keys, "type", "action_date", F.inline(items)).groupBy(*self.pair).agg(
            *[
                F.max("action_date" if t is None else F.when(F.col("type") == t, F.col("action_date"))).alias(c)
                for t, c in self.latest.items()
            ]
        )

    def start(self, log: DataFrame, day: date) -> None:
        """The state of a first day, from the log of its longest window."""
        if self.state.last():
            raise ValueError(f"the state of {self.state.last()} is there already")
        pairs = self._pairs(log, day - timedelta(days=max(self.windows) - 1), day)
        self.state.publish(day, pairs.repartition(self.state.buckets, self.state.bucket()), list(range(self.state.buckets)))

    def advance(self, log: DataFrame) -> date:
        """Add the day after the last one; returns it."""
        before = self.state.last()
        if before is None:
            raise ValueError("start with a first day")
        day = before + timedelta(days=1)
        both = self.state.rows().unionByName(self._pairs(log, day, day)).repartition(self.state.buckets, self.state.bucket())
        merged = both.groupBy(*self.pair).agg(*[F.max(c).alias(c) for c in self.latest.values()])
        kept = merged.where(F.col("latest") > F.lit(day - timedelta(days=max(self.windows))))
        self.state.publish(day, kept, list(range(self.state.buckets)))
        return day

    def counts(self) -> DataFrame:
        """(keys, anchor_date, counts) of the last day; valid until two further days are added."""
        day = self.state.last()
        counts = [
            F.expr(
                f"count_if(what = '{v}' and value is not null and {c} > date'{day - timedelta(days=n)}')"
            ).alias(breadth_name(self.keys, t, v, n))
            for n in self.windows for v in self.values for t, c in self.latest.items()
        ]
        return self.state.rows().groupBy(*self.keys).agg(*counts).withColumn("anchor_date", F.lit(day))
