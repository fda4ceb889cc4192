"""Line deduplication through a sharded minimal perfect hash.

Distinct hashes of lines that several documents hold are dealt to shards. Each shard is a minimal
perfect hash with arrays beside it: a 64-bit fingerprint that tells members from strangers, the
number of documents (up to what the rule needs) and the document that keeps the line. Documents send packed
probes to the shards, whose arrays answer them with the numbers of the lines to drop; lines are never joined.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys are told apart
by 128 hash bits (64 choose shard and index, 64 are the fingerprint).

Skew: a task sends at most ``least_docs`` documents per line, the largest ids, which is enough for
both the count and the keeper, so a line found in a third of all documents travels that often per
slice of input only. A shard with many probes answers them in parts of ``group_bytes``. The plan is the same at
any size: no array passes through the driver, and the rows that lose lines come back to the texts by one join.

Defined results: null and empty texts are one empty line; a document is its ``doc_id``: rows that
repeat one count once, and all keep a line if they hold the largest id; null ids count as one
document, smaller than any other; an empty table gives no rows; columns named like the added ones
(``n_lines``, ``n_dropped``) are replaced, all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slices, texts, wide, written
from shoplens.llm.perfect_hash import PerfectHash

SPACE = b" \t\n\x0b\x0c\r"
# Probes of a shard that one task answers.
GROUP_BYTES = 64 << 20
NO_DOC = np.iinfo("int64").min
ENTRY = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i8")])
PROBE = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("line", "<i8")])


def key_of(line: bytes, shortest: int) -> bytes | None:
    """The line's key, or None if it has fewer than ``shortest`` code points."""
    if len(line) < shortest:
        return None
    key = line.strip(SPACE).lower()
    n = len(key)
    if n < 4 * shortest and n - sum(128 <= b < 192 for b in key) < shortest:
        return None
    return key


def _hashed(batch: list[bytes], shortest: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text; then per line with a key: number of its text, number in it, 128-bit hash."""
    split, owner, number, digests = [], [], [], []
    for i, text in enumerate(batch):
        lines = text.split(b"\n")
        split.append(lines)
        for j, line in enumerate(lines):
            key = key_of(line, shortest)
            if key is not None:
                owner.append(i)
                number.append(j)
                digests.append(xxhash.xxh3_128_digest(key))
    hashes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return split, np.array(owner, "int64"), np.array(number, "int64"), hashes


def _doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([NO_DOC if x is None else x for x in batch.column("doc_id").to_pylist()], "int64")


def largest_docs(entries: np.ndarray, most: int) -> np.ndarray:
    """Per hash the ``most`` largest distinct documents, in descending order."""
    entries = entries[np.lexsort((~entries["doc"], entries["low"], entries["high"]))]
    if not len(entries):
        return entries
    same = (entries["high"][1:] == entries["high"][:-1]) & (entries["low"][1:] == entries["low"][:-1])
    entries = entries[np.concatenate([[True], ~(same & (entries["doc"][1:] == entries["doc"][:-1]))])]
    same = np.concatenate([[False], (entries["high"][1:] == entries["high"][:-1]) & (entries["low"][1:] == entries["low"][:-1])])
    place = np.arange(len(entries))
    return entries[place - np.maximum.accumulate(np.where(same, 0, place)) < most]


def build_shard(entries: np.ndarray, least_docs: int) -> tuple[int, bytes]:
    """Number of lines in at least two documents, and their hash with its arrays."""
    entries = largest_docs(entries, least_docs)
    first = np.flatnonzero(np.concatenate([[True], (entries["high"][1:] != entries["high"][:-1]) | (entries["low"][1:] != entries["low"][:-1])])) if len(entries) else np.empty(0, "int64")
    docs = np.diff(np.append(first, len(entries)))
    shared = docs >= min(2, least_docs)
    lines, docs = entries[first[shared]], docs[shared]
    # Two lines that agree in the first 64 bits cannot both be indexed; the others are listed behind.
    _, kept = np.unique(lines["high"], return_index=True)
    spare = np.delete(np.arange(len(lines)), kept)
    function = PerfectHash.build(lines["high"][kept])
    place = function.index(lines["high"][kept])
    order = np.concatenate([kept[np.argsort(place)], spare])
    arrays = (lines["low"][order], lines["doc"][order], docs[order].astype("uint8"), lines["high"][spare])
    sizes = np.array([len(order), len(spare)], "<u4").tobytes()
    return len(order), sizes + function.to_bytes() + b"".join(a.tobytes() for a in arrays)


class Shard:
    """A shard read back; ``keeper`` answers probes."""

    def __init__(self, data: bytes, least_docs: int) -> None:
        n, spare = (int(x) for x in np.frombuffer(data, "<u4", 2))
        self.function, at = PerfectHash.from_bytes(data[8:])
        at += 8
        self.low = np.frombuffer(data, "<u8", n, at)
        self.doc = np.frombuffer(data, "<i8", n, at + 8 * n)
        self.many = np.frombuffer(data, "uint8", n, at + 16 * n) >= least_docs
        self.spare = np.frombuffer(data, "<u8", spare, at + 17 * n)

    def keeper(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per line: whether enough documents hold it, and which one keeps it."""
        n = len(self.low) - len(self.spare)
        place = self.function.index(high) if n else np.full(len(high), -1, "int64")
        for i, own in enumerate(self.spare):
            place[(high == own) & (low == self.low[n + i])] = n + i
        at = np.maximum(place, 0)
        if not len(self.low):
            return np.zeros(len(high), bool), np.zeros(len(high), "int64")
        return (place >= 0) & (self.low[at] == low) & self.many[at], self.doc[at]


def line_index(docs: DataFrame, shards: int, shortest: int = 20, least_docs: int = 3) -> DataFrame:
    """(shard, n_lines, arrays): one row per shard, written to the shared folder."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = _doc_ids(batch)
            _, owner, _, hashes = _hashed(texts(batch), shortest)
            entries = np.empty(len(owner), ENTRY)
            entries["high"], entries["low"], entries["doc"] = hashes[:, 0], hashes[:, 1], ids[owner]
            entries = largest_docs(entries, least_docs)
            shard = (entries["high"] % np.uint64(shards)).astype("int64")
            order = np.argsort(shard, kind="stable")
            entries, shard = entries[order], shard[order]
            names, first = np.unique(shard, return_index=True)
            packed = [x.tobytes() for x in np.split(entries, first[1:])] if len(names) else []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["shard", "entries"])

    def build(group: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(group.column("entries").to_pylist()), ENTRY)
        n, arrays = build_shard(entries, least_docs)
        return pa.table({"shard": group.column("shard")[:1], "n_lines": pa.array([n], pa.int64()), "arrays": pa.array([arrays], pa.binary())})

    sent = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(send, "shard bigint, entries binary")
    built = sent.groupBy("shard").applyInArrow(build, "shard bigint, n_lines bigint, arrays binary")
    return written(built.where("n_lines > 0"), "line_index")


def _probes(docs: DataFrame, shards: int, shortest: int) -> DataFrame:
    """(shard, n_bytes, probes): per slice of the input and shard the packed lines to look up, each with the
    row it stands in; written to the shared folder."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, rows = batch.column("_ld_id").to_numpy(), batch.column("_ld_text").to_numpy()
            _, owner, line, hashes = _hashed(texts(batch), shortest)
            probes = np.empty(len(owner), PROBE)
            probes["high"], probes["low"], probes["line"] = hashes[:, 0], hashes[:, 1], line
            probes["doc"], probes["text"] = ids[owner], rows[owner]
            shard = (probes["high"] % np.uint64(shards)).astype("int64")
            order = np.argsort(shard, kind="stable")
            names, first = np.unique(shard[order], return_index=True)
            packed = [x.tobytes() for x in np.split(probes[order], first[1:])] if len(names) else []
            columns = [pa.array(names, pa.int64()), pa.array([len(x) for x in packed], pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "n_bytes", "probes"])

    sent = docs.select("_ld_id", "_ld_text", "text").mapInArrow(send, "shard bigint, n_bytes bigint, probes binary")
    return written(sent, "line_probes")


def dropped_lines(probes: DataFrame, index: DataFrame, least_docs: int, group_bytes: int) -> DataFrame:
    """(_ld_id, _ld_text, _ld_dropped): per row that loses lines, their numbers. A shard with more probes than
    ``group_bytes`` answers them in several tasks, each with the shard's arrays."""
    parts = F.least(F.ceil(F.sum("n_bytes") / group_bytes), F.count("*")).cast("int").alias("parts")
    sizes = probes.groupBy("shard").agg(parts)
    asked = probes.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("probes"), "parts").cast("int"))
    arrays = index.join(sizes, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def answer(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        lost = np.empty(0, PROBE)
        if asked.num_rows and arrays.num_rows:
            shard = Shard(arrays.column("arrays")[0].as_py(), least_docs)
            found = []
            for packed in asked.column("probes"):
                probe = np.frombuffer(packed.as_buffer(), PROBE)
                many, keeper = shard.keeper(probe["high"], probe["low"])
                found.append(probe[many & (keeper != probe["doc"])])
            lost = np.concatenate(found)
        return pa.table({c: pa.array(np.ascontiguousarray(lost[n]), pa.int64()) for c, n in (("_ld_id", "doc"), ("_ld_text", "text"), ("line", "line"))})

    groups = asked.select("shard", "part", "probes").groupBy("shard", "part").cogroup(arrays.select("shard", "part", "arrays").groupBy("shard", "part"))
    lost = groups.applyInArrow(answer, "_ld_id bigint, _ld_text bigint, line bigint")
    return lost.groupBy("_ld_id", "_ld_text").agg(F.collect_set("line").alias("_ld_dropped"))


def dedup_lines(
    docs: DataFrame, shortest: int = 20, least_docs: int = 3, shards: int | None = None, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``docs`` without the lines that ``least_docs`` documents or more hold, but for the largest id.

    Adds ``n_lines`` (before) and ``n_dropped``.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "_ld_id", "_ld_text", "_ld_dropped")]
    passed = docs.select(*own)
    result = passed.withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    shards = shards or max(wide(spark, 0, 1), docs.select("text").rdd.getNumPartitions())
    index = line_index(passed, shards, shortest, least_docs)
    # A row is known by its id and its text; rows equal in both lose the same lines.
    keyed = passed.withColumns({"_ld_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC)), "_ld_text": F.xxhash64("text")})
    lost = written(dropped_lines(_probes(keyed, shards, shortest), index, least_docs, group_bytes), "dropped_lines")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            split = [text.split(b"\n") for text in texts(batch)]
            gone = [set(x or ()) for x in batch.column("_ld_dropped").to_pylist()]
            kept = [b"\n".join([x for j, x in enumerate(lines) if j not in out]) for lines, out in zip(split, gone, strict=True)]
            added = {
                "text": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_lines": pa.array([len(x) for x in split], pa.int64()),
                "n_dropped": pa.array([len(x) for x in gone], pa.int64()),
            }
            yield _with(batch, added, result.names)

    return keyed.join(lost, ["_ld_id", "_ld_text"], "left").mapInArrow(cut, result)


def _with(batch: pa.RecordBatch, added: dict[str, pa.Array], names: list[str]) -> pa.RecordBatch:
    lower = {k.lower(): v for k, v in added.items()}
    return pa.RecordBatch.from_arrays([lower[n.lower()] if n.lower() in lower else batch.column(n) for n in names], names)
