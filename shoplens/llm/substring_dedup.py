"""Substring deduplication through super-k-mers.

A window is ``width`` consecutive words of one document. Runs of ``M`` words are hashed, and a window's
minimiser is the smallest of its hashes; consecutive windows with one minimiser travel as one packed
string, a super-k-mer, to the bucket of that minimiser. All occurrences of a window meet there, where a
sort of the spelt windows counts them exactly. Words covered by a window that starts anywhere else
too are removed.

What need not travel stays: minimisers are counted first, and a super-k-mer whose minimiser occurs
once in the corpus holds no repeated window. The counts leave a bit map of fixed size (``MAP_BITS``,
broadcast at any input size); bits shared by chance cost a trip, never a result. A super-k-mer that
a slice of documents holds several times is found repeated on the spot and sent once.

Skew: minimisers with more than ``1 / HOT`` of all occurrences, fewer than ``HOT`` by definition, send
each window by its own hash instead, so that a common passage spreads over the buckets.

Defined results: null and empty texts have no words; texts shorter than a window keep all; rows that
repeat one ``doc_id`` are documents of their own, so equal rows are repeats of each other; an empty
table gives no rows; columns named like the added ones (``n_words``, ``n_removed``) are replaced, all
others stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slices, texts, wide, written

M = 10
MAP_BITS = 28
MAP_PARTS = 64
HOT = 20_000
# Text that a task works on at once; its arrays take about 30 times as much.
SLICE_BYTES = 4 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word of a byte buffer, by sums of bytes times powers of their place."""
    sizes = ends - starts
    places = np.arange(len(buffer)) - np.repeat(np.append(starts, 0)[: len(starts)], np.diff(np.append(starts, len(buffer))))
    powers = np.cumprod(np.full(int(sizes.max()) + 2, MIX | np.uint64(1)), dtype="uint64")
    inside = places < np.repeat(sizes, np.diff(np.append(starts, len(buffer))))
    terms = np.where(inside, (buffer.astype("uint64") + np.uint64(1)) * powers[np.minimum(places, len(powers) - 1)], np.uint64(0))
    return _mixed(np.add.reduceat(terms, starts) + sizes.astype("uint64"))


def _run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, by doubling; runs past the end are meaningless."""
    total, done, step, power = np.zeros(len(words), "uint64"), 0, 1, MIX
    block, rest = words, length
    shift = lambda x, n: np.concatenate([x[n:], np.zeros(min(n, len(x)), "uint64")])
    while rest:
        if rest & 1:
            total = total * power + shift(block, done)
            done += step
        block = block * power + shift(block, step)
        power, step, rest = power * power, 2 * step, rest >> 1
    return _mixed(total)


def _window_minima(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of ``width`` consecutive values from each place, and where it is first, by doubling."""
    top = np.uint64(2**64 - 1)
    place = np.arange(len(x))

    def joined(x: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        later = np.concatenate([x[n:], np.full(min(n, len(x)), top)])
        take = later < x
        return np.where(take, later, x), np.where(take, np.concatenate([place[n:], place[: min(n, len(x))]]), place)

    step = 1
    while 2 * step <= width:
        x, place = joined(x, place, step)
        step *= 2
    return joined(x, place, width - step) if step < width else (x, place)


class Windows:
    """All windows of a batch of texts, as flat arrays over its words."""

    def __init__(self, batch: list[bytes], width: int) -> None:
        split = [t.split() for t in batch]
        counts = np.fromiter(map(len, split), "int64", len(split))
        self.joined = b" ".join([b" ".join(w) for w in split if w])
        sizes = np.fromiter((len(w) for words in split for w in words), "int64", int(counts.sum()))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.text_of = np.repeat(np.arange(len(batch)), counts)
        self.place = np.arange(len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts)
        valid = self.place + width <= counts[self.text_of] if len(sizes) else np.empty(0, bool)
        self.width, self.counts = width, counts
        self.at = np.flatnonzero(valid)  # word where each window starts
        if len(self.at):
            with np.errstate(over="ignore"):
                self.words = word_hashes(np.frombuffer(self.joined, "uint8"), self.starts, self.ends)
                short = min(M, width)
                minima, places = _window_minima(_run_hashes(self.words, short), width - short + 1)
            self.minimiser, self.minimised = minima[self.at], places[self.at]

    def own_hashes(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _run_hashes(self.words, self.width)[self.at]

    def pieces(self, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last window and key of each super-k-mer; windows of hot minimisers stand alone."""
        key = self.minimiser
        same = (self.at[1:] == self.at[:-1] + 1) & (key[1:] == key[:-1]) & (self.text_of[self.at[1:]] == self.text_of[self.at[:-1]])
        if hot is not None and len(hot):
            single = np.isin(key, hot)
            if single.any():
                key = np.where(single, self.own_hashes(), key)
                same &= ~single[1:] & ~single[:-1]
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        return first, np.append(first[1:], len(key)) - 1, key[first]

    def occurrences(self, first: np.ndarray) -> np.ndarray:
        """1 per piece, or 2 where its minimiser occurs several times in it: it may repeat itself."""
        moved = np.concatenate([[False], self.minimised[1:] != self.minimised[:-1]])
        moved[first] = False
        return 1 + (np.add.reduceat(moved, first) > 0)

    def spelt(self, first: int, last: int) -> bytes:
        return self.joined[self.starts[self.at[first]] : self.ends[self.at[last] + self.width - 1]]


def repeated_minimisers(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit map of minimiser hashes that occur at least twice, and the hot minimisers."""
    low = MAP_BITS - MAP_PARTS.bit_length() + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SLICE_BYTES):
            found = Windows(texts(batch), width)
            first, _, keys = found.pieces() if len(found.at) else (None, None, np.empty(0, "uint64"))
            keys, place = np.unique(keys, return_inverse=True)
            times = np.bincount(place, found.occurrences(first)).astype("int64") if len(keys) else np.empty(0, "int64")
            part = ((keys >> np.uint64(low)) % np.uint64(MAP_PARTS)).astype("int64")
            order = np.argsort(part, kind="stable")
            names, first = np.unique(part[order], return_index=True)
            packed = np.stack([keys, times.astype("uint64")], axis=1)[order]
            payload = [x.tobytes() for x in np.split(packed, first[1:])] if len(names) else []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(payload, pa.binary())], ["part", "counts"])

    def merge(group: pa.Table) -> pa.Table:
        packed = np.frombuffer(b"".join(group.column("counts").to_pylist()), "uint64").reshape(-1, 2)
        keys, place = np.unique(packed[:, 0], return_inverse=True)
        times = np.bincount(place, packed[:, 1].astype("float64"))
        bits = np.zeros(1 << low, bool)
        bits[(keys[times > 1] & np.uint64((1 << low) - 1)).astype("int64")] = True
        # The parts hold equal shares of all occurrences but for hot keys, so a part's own total
        # stands for its share of the whole.
        common = keys[times > max(64, times.sum() * MAP_PARTS / HOT)][:HOT]
        return pa.table({
            "part": group.column("part")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "hot": pa.array([common.view("int64").tolist()], pa.list_(pa.int64())),
        })

    sent = docs.select("text").mapInArrow(send, "part bigint, counts binary")
    rows = sent.groupBy("part").applyInArrow(merge, "part bigint, bits binary, hot array<bigint>").collect()
    bits = np.zeros((MAP_PARTS, (1 << low) // 8), "uint8")
    for r in rows:
        bits[r["part"]] = np.frombuffer(r["bits"], "uint8")
    return bits.ravel(), np.array(sorted(x for r in rows for x in r["hot"]), "int64").view("uint64")


ROW = "row_key bigint, doc_id bigint, first bigint, last bigint"


def repeated_spans(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, row_key, spans): per document the starts [first, last] of windows that are repeated."""
    spark = docs.sparkSession
    bits, hot = repeated_minimisers(docs, width)
    sent = spark.sparkContext.broadcast((bits, hot))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot = sent.value
        for batch in slices(batches, most_bytes=SLICE_BYTES):
            found = Windows(texts(batch), width)
            out: list[tuple] = []
            if len(found.at):
                first, last, key = found.pieces(hot)
                place = found.minimiser[first] & np.uint64((1 << MAP_BITS) - 1)
                seen = (bits[(place >> np.uint64(3)).astype("int64")] >> (7 - (place & np.uint64(7))).astype("uint8")) & 1 == 1
                first, last, key = first[seen], last[seen], key[seen]
                ids, rows = batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist()
                spelt = [found.spelt(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                owner = found.text_of[found.at[first]].tolist()
                start = found.place[found.at[first]].tolist()
                size = (last - first).tolist()
                times: dict[bytes, int] = {}
                for s in spelt:
                    times[s] = times.get(s, 0) + 1
                told: set[bytes] = set()
                for k, s, o, p, n in zip(key.view("int64").tolist(), spelt, owner, start, size, strict=True):
                    if times[s] == 1:
                        out.append((k, s, rows[o], ids[o], p, n))
                        continue
                    # Repeated within the slice: all its windows are, and others need one copy to see.
                    out.append((None, None, rows[o], ids[o], p, p + n))
                    if s not in told:
                        told.add(s)
                        out.append((k, s, None, None, -1, n))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["key", "words", *[x.split()[0] for x in ROW.split(", ")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        keys = table.column("key").to_numpy()[order]
        words = table.column("words").to_pylist()
        rows, ids, start, more = (table.column(c).to_pylist() for c in ("row_key", "doc_id", "first", "last"))
        out: list[tuple] = []
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for group in np.split(order, cuts):
            own = group.tolist()
            if len(own) == 1 and not more[own[0]]:
                continue  # one window
            # A copy told by a slice (start -1) stands for two occurrences.
            windows = sorted((w, i, j) for i in own for j, w in enumerate(_spell(words[i], width)))
            hits: dict[int, list[int]] = {}
            at = 0
            while at < len(windows):
                end = at + 1
                while end < len(windows) and windows[end][0] == windows[at][0]:
                    end += 1
                if end - at > 1 or start[windows[at][1]] < 0:
                    for _, i, j in windows[at:end]:
                        if start[i] >= 0:
                            hits.setdefault(i, []).append(start[i] + j)
                at = end
            for i, places in hits.items():
                places = np.array(sorted(places))
                for x in np.split(places, np.flatnonzero(places[1:] > places[:-1] + 1) + 1):
                    out.append((rows[i], ids[i], int(x[0]), int(x[-1])))
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in ROW.split(", ")])

    travelled = docs.mapInArrow(send, f"key bigint, words binary, {ROW}")
    travelled = written(travelled, "super_kmers")
    known = travelled.where("key IS NULL").select("row_key", "doc_id", "first", "last")
    meeting = travelled.where("key IS NOT NULL")
    rows = meeting.count()
    counted = meeting.repartition(wide(spark, rows, 200_000), "key").mapInArrow(count, ROW)
    spans = known.unionByName(counted).groupBy("doc_id", "row_key")
    return spans.agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("_spans"))


def _spell(words: bytes, width: int) -> list[bytes]:
    """Windows of a packed string."""
    gaps = [-1]
    at = words.find(b" ")
    while at >= 0:
        gaps.append(at)
        at = words.find(b" ", at + 1)
    gaps.append(len(words))
    return [words[gaps[i] + 1 : gaps[i + width]] for i in range(len(gaps) - width)]


def dedup_substrings(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` without the words that repeated windows cover; kept words are joined by one space.

    Adds ``n_words`` (before) and ``n_removed``. A row is known by its id and a hash of its text, so
    that equal rows, which lose the same words, need not be told apart.
    """
    own = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "_spans", "row_key")]
    docs = docs.select(*own)
    keyed = docs.withColumn("row_key", F.xxhash64("text"))
    spans = repeated_spans(keyed.select(F.col("doc_id").cast("long"), "row_key", F.coalesce("text", F.lit("")).alias("text")), width)
    both = keyed.alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.row_key") == F.col("s.row_key")), "left")
    joined = both.select(*[F.col(f"d.{c}") for c in own], F.col("s._spans"))
    result = joined.drop("_spans").withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long")}).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, total, removed = [], [], []
            for text, spans in zip(texts(batch), batch.column("_spans").to_pylist(), strict=True):
                words = text.split()
                left, at = [], 0
                for span in spans or ():
                    if span["first"] > at:
                        left += words[at : span["first"]]
                    at = max(at, span["last"] + width)
                left += words[at:]
                kept.append(b" ".join(left))
                total.append(len(words))
                removed.append(len(words) - len(left))
            added = {"text": pa.array(kept, pa.binary()).cast(pa.string()), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
            yield pa.RecordBatch.from_arrays([added[n] if n in added else batch.column(n) for n in result.names], result.names)

    return joined.mapInArrow(cut, result)
