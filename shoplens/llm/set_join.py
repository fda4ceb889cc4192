"""Near duplicates by the exact Jaccard similarity of their word shingles, with a prefix filter.

Documents whose sets of shingles have a similarity of ``least`` or more are linked, and linked documents
form classes. Every such pair is found and every link is verified on the whole sets.

Candidates: two sets of that similarity share one at least of the first ``n - ceil(least * n) + 1``
shingles of each, in any order that is the same for all sets. Here common shingles come last, so that
passages which many documents quote are no meeting place. Which are common is counted per slice of the
input; a miscount makes more candidates, never fewer links.

Before whole sets are compared, candidates meet as bit maps in which each shingle flips one bit: two maps
cannot differ in more bits than the sets differ in shingles, so what is too far there is no link.

Places where many sets meet are first linked through one set at a time, and sets that links already
connect are not compared again; when that brings little more, all pairs that no link connects are compared.

Defined results: shingles are known by 64-bit hashes; a text shorter than a shingle is one shingle;
null and empty texts are equal to each other and to nothing else; equal sets are one node, so copies
never form pairs; null ids take part and come last in the order of keepers; an empty table gives no
rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import few, slices, texts, wide, written
from shoplens.llm.graph import components

# Shingles that come last in the order, at most, and documents of a slice that make one common.
COMMON, COMMON_DOCS = 500_000, 4
# Up to this many sets a meeting place is compared pair by pair at once; rounds of single sets for others.
PAIRWISE, HUB_ROUNDS = 48, 6
SLICE_BYTES = 8 << 20
# Text whose shingles a worker of the exact join makes at once; they take many times its memory.
SHINGLED_BYTES = 1 << 20
# Whole sets that one file takes.
SETS_PER_FILE = 20_000
# Bits of the map of texts whose sets are wanted.
MAP_BITS = 1 << 25
# Slots of a coarser map that is joined with the rows before their texts are sent to Python.
SLOTS = 1 << 20
PLACED = ("key", "node", "n", "place", "root")
# Stands for a null id, after all others.
NO_ID = int(np.iinfo("int64").max)
# Room for rounding in products with ``least``.
TINY = 1e-9

Prints = Callable[[bytes], np.ndarray]


def shingle_sets(batch: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, and the text's number; ordered by number and hash."""
    split = [t.lower().split() for t in batch]
    sizes = np.fromiter(map(len, split), "int64", len(split))
    words = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(split)), "uint64", int(sizes.sum()))
    width = np.where(sizes > 0, np.maximum(sizes, shingle), 0)
    first = np.cumsum(width) - width
    padded = np.zeros(int(width.sum()), "uint64")
    padded[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(words))] = words
    steps = np.where(sizes > 0, width - shingle + 1, 0)
    owner = np.repeat(np.arange(len(split)), steps)
    at = np.repeat(first - (np.cumsum(steps) - steps), steps) + np.arange(len(owner))
    h = np.zeros(len(at), "uint64")
    for k in range(shingle):
        h = (h ^ padded[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h = (h * np.uint64(0xBF58476D1CE4E5B9)).view("int64")
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[fresh], owner[fresh]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    ends = np.cumsum(np.bincount(owner, minlength=n))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int64()))


def _nodes(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """64-bit name of each set."""
    ends = np.cumsum(np.bincount(owner, minlength=n))
    return np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in np.split(hashes, ends[:-1])], "uint64").view("int64")


def common_shingles(docs: DataFrame, shingle: int, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles in ascending order, and in how many documents they were counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SLICE_BYTES):
            parts = slices(iter([batch]), most_bytes=SHINGLED_BYTES)
            found, n = np.unique(np.concatenate([shingle_sets(texts(part), shingle)[0] for part in parts]), return_counts=True)
            many = n >= COMMON_DOCS
            yield pa.RecordBatch.from_arrays([pa.array(found[many]), pa.array(n[many].astype("int64"))], ["shingle", "n"])

    counted = docs.select("text").mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    found, n = (top.column(c).to_numpy() for c in ("shingle", "n"))
    order = np.argsort(found)
    return found[order], n[order]


def prefixes(hashes: np.ndarray, owner: np.ndarray, n: int, least: float, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The part of each set in which it meets every set that is similar enough."""
    names, weights = common
    weight = np.zeros(len(hashes), "int64")
    if len(names):
        at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
        weight = np.where(names[at] == hashes, weights[at], 0)
    order = np.lexsort((hashes, weight, owner))
    sizes = np.bincount(owner, minlength=n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    length = sizes - np.ceil(least * sizes - TINY).astype("int64") + 1
    kept = place < length[owner]
    return hashes[order][kept], owner[kept]


def flips(hashes: np.ndarray) -> bytes:
    """Bit map of a set, of a power of two bits and at least one per shingle: each shingle flips one bit."""
    n_bits = 1 << max(6, (len(hashes) - 1).bit_length())
    at = (hashes.view("uint64") >> np.uint64(16)) & np.uint64(n_bits - 1)
    return np.packbits(np.bincount(at.astype("int64"), minlength=n_bits) & 1).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """In how many bits two maps differ, the longer one folded: at most the number of shingles in one set only."""
    short, long = sorted((np.frombuffer(x, "uint8"), np.frombuffer(y, "uint8")), key=len)
    while len(long) > len(short):
        half = len(long) // 2
        long = long[:half] ^ long[half:]
    return int(np.bitwise_count(short ^ long).sum())


def marks(docs: DataFrame, shingle: int, least: float, common: tuple[np.ndarray, np.ndarray], prints: Prints | None = None) -> DataFrame:
    """(doc_id, text_hash, node, n, prefix, flips, prints) per row: the set's name, its size, its meeting places
    and its bit map, and what ``prints`` makes of the text, nothing if it is not given."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SHINGLED_BYTES):
            rows = batch.num_rows
            found = texts(batch)
            hashes, owner = shingle_sets(found, shingle)
            sizes = np.bincount(owner, minlength=rows)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(_nodes(hashes, owner, rows))]
            columns += [pa.array(sizes.astype("int32")), _lists(*prefixes(hashes, owner, rows, least, sent.value), rows)]
            columns += [pa.array([flips(x) for x in np.split(hashes, np.cumsum(sizes)[:-1])], pa.binary())]
            columns += [pa.array([prints(t) for t in found] if prints else [[]] * rows, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "n", "prefix", "flips", "prints"])

    plain = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return plain.mapInArrow(run, "doc_id bigint, text_hash bigint, node bigint, n int, prefix array<bigint>, flips binary, prints array<bigint>")


def _bit(doc_id: Column, text_hash: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, text_hash), F.lit(MAP_BITS))


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int, most_bytes: int = SLICE_BYTES) -> DataFrame:
    """(node, shingles) of the rows ``wanted`` (doc_id, text_hash), and of some others."""
    return sets_by_row(docs, wanted, shingle, most_bytes).select("node", "shingles").dropDuplicates(["node"])


def sets_by_row(docs: DataFrame, wanted: DataFrame, shingle: int, most_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, text_hash, node, shingles) of the rows ``wanted`` (doc_id, text_hash), and of some others. A bit
    map of fixed size keeps most other texts from being worked on; none of the wanted is lost. Null ids are
    ``NO_ID`` on both sides."""
    bit = _bit(F.col("doc_id"), F.col("text_hash"))
    words = wanted.select(bit.alias("bit")).select(F.shiftright("bit", 5).cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(MAP_BITS // 32, "uint32")
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype("uint32")
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            chosen = batch.filter(pa.array((sent.value[bit // 32] >> (bit % 32).astype("uint32") & 1).astype(bool)))
            for part in slices(iter([chosen]), most_bytes=most_bytes):
                hashes, owner = shingle_sets(texts(part), shingle)
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(_nodes(hashes, owner, part.num_rows)), _lists(hashes, owner, part.num_rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "shingles"])

    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sent_rows = named.withColumn("bit", _bit(F.col("doc_id"), F.col("text_hash")))
    return sent_rows.mapInArrow(run, "doc_id bigint, text_hash bigint, node bigint, shingles array<bigint>")


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    parts = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _starts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys starts, and its length."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return first, np.diff(np.append(first, len(keys)))


def places(nodes: DataFrame, partitions: int) -> DataFrame:
    """(key, node, n, place, met) for each shingle in the prefixes of several sets: its place in the set's
    order, and in how many it is."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _columns(batches)
        if columns:
            order = np.lexsort((columns[1], columns[0]))
            keys, node, n, place = (x[order] for x in columns)
            _, sizes = _starts(keys)
            met = np.repeat(sizes, sizes)
            kept = met > 1
            found = [x[kept] for x in (keys, node, n, place, met.astype("int64"))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["key", "node", "n", "place", "met"])

    posted = nodes.select(F.posexplode("prefix").alias("place", "key"), "node", "n").select("key", "node", "n", "place")
    return posted.repartition(partitions, "key").mapInArrow(meet, "key bigint, node bigint, n int, place int, met bigint")


def candidates(placed: DataFrame, least: float, partitions: int, every: bool) -> DataFrame:
    """(a, b) to compare, a < b, from ``placed`` (key, node, n, place, root): sets that meet, are in different
    classes and are similar if all that follows the key is shared. Of a similar pair this holds at the first
    shingle that both have. Large places give the pairs of one set, with ``every`` all."""

    def open_(n: np.ndarray, rest: np.ndarray, root: np.ndarray, i: np.ndarray | int, j: np.ndarray) -> np.ndarray:
        return (root[i] != root[j]) & (np.minimum(rest[i], rest[j]) * (1 + least) >= least * (n[i] + n[j]) - TINY)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        columns = _columns(batches)
        if not columns:
            return
        order = np.lexsort((columns[1], columns[0]))
        keys, node, n, place, root = (x[order] for x in columns)
        rest = n - place
        first, sizes = _starts(keys)
        left = np.repeat(np.where(sizes <= PAIRWISE, sizes, 0), sizes) - (np.arange(len(keys)) - np.repeat(first, sizes))
        for step in range(1, PAIRWISE):
            at = np.flatnonzero(left > step)
            at = at[open_(n, rest, root, at, at + step)]
            yield node[at], node[at + step]
        for start, size in zip(first[sizes > PAIRWISE], sizes[sizes > PAIRWISE], strict=True):
            own = slice(start, start + size)
            if every:
                for i in range(start, start + size - 1):
                    later = np.arange(i + 1, start + size)
                    later = later[open_(n, rest, root, i, later)]
                    yield np.full(len(later), node[i]), node[later]
            else:
                names, many = np.unique(root[own], return_counts=True)
                stray = start + np.flatnonzero(root[own] != names[many.argmax()])
                if len(stray):
                    hub = stray[np.argsort(n[stray], kind="stable")[len(stray) // 2]]
                    other = np.arange(start, start + size)
                    other = other[open_(n, rest, root, hub, other)]
                    yield np.full(len(other), node[hub]), node[other]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for a, b in pairs(batches):
            held.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            rows += len(a)
            if rows > 1_000_000:
                yield _distinct(held)
                held, rows = [], 0
        if rows:
            yield _distinct(held)

    return placed.repartition(partitions, "key").mapInArrow(run, "a bigint, b bigint").distinct()


def _distinct(held: list[np.ndarray]) -> pa.RecordBatch:
    found = np.concatenate(held)
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]).any(axis=1)
    return pa.RecordBatch.from_arrays([pa.array(found[fresh, 0].copy()), pa.array(found[fresh, 1].copy())], ["a", "b"])


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, linked): whether the sets' similarity reaches ``least``."""
    for side, name in (("b", "y"), ("a", "x")):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(name)), side)
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.select("a", "b", (shared * (1 + least) >= least * (F.size("x") + F.size("y")) - TINY).alias("linked"))


def possible(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """``pairs`` (a, b) without those whose bit maps differ too much for that similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n = (batch.column(c).to_pylist() for c in ("x", "y", "n"))
            most = np.array(n, "float64") * (1 - least) / (1 + least) + TINY
            near = np.fromiter(map(differing, x, y), "int64", len(n)) <= most
            yield batch.select(["a", "b"]).filter(pa.array(near))

    for side, name in (("b", "y"), ("a", "x")):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("flips").alias(name), F.col("n").alias(f"n_{name}")), side)
    return pairs.select("a", "b", "x", "y", (F.col("n_x") + F.col("n_y")).alias("n")).mapInArrow(run, "a bigint, b bigint")


def compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b, linked) of those ``pairs`` that bit maps leave possible, by whole sets, which are made for them alone."""
    left = written(possible(pairs, nodes, least), "possible")
    n_left = left.count()
    if not n_left:
        return left.withColumn("linked", F.lit(False))
    named = nodes.join(left.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    named = named.select(F.col("k._sj_id").alias("doc_id"), F.col("k._sj_text").alias("text_hash"))
    named = written(few(named, 2 * n_left), "named")
    # The slots taken are few enough to be broadcast at any size, so most other texts never leave the scan.
    slot = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.xxhash64("text")), F.lit(SLOTS)).cast("int")
    taken = named.select(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SLOTS)).cast("int").alias("_sj_slot")).distinct()
    likely = docs.select("doc_id", "text", slot.alias("_sj_slot")).join(written(few(taken, min(SLOTS, 2 * n_left)), "slots"), "_sj_slot", "left_semi")
    sets = written(few(sets_of(likely, named, shingle, SHINGLED_BYTES), 2 * n_left, SETS_PER_FILE), "sets")
    return written(few(similar(left, sets, least), n_left, SETS_PER_FILE), "compared")


def links(placed: DataFrame, first: DataFrame, compare: Callable[[DataFrame], DataFrame], least: float, partitions: int, tested: DataFrame | None = None) -> DataFrame:
    """(a, b) verified links that connect all sets whose similarity reaches ``least``; ``first`` are the first
    candidates, ``tested`` (a, b, linked) what is compared already."""
    every, before, rounds = False, None, 0
    wanted = first
    while True:
        found = compare(wanted)
        tested = found if tested is None else written(tested.unionByName(found), "tested")
        large = placed.where(F.col("met") > PAIRWISE)
        if every or large.isEmpty():
            return tested.where("linked").select("a", "b")
        named = _rooted(large, tested)
        mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        open_places = written(named.join(mixed.select("key"), "key", "left_semi"), "open_places")
        left = _open_pairs(open_places)
        if not left:
            return tested.where("linked").select("a", "b")
        rounds += 1
        # All pairs are compared when they are few, or when single sets connect little more.
        every = left <= 4 * placed.count() or rounds >= HUB_ROUNDS or (before is not None and left > 0.8 * before)
        before = left
        wanted = candidates(open_places.select(*PLACED), least, partitions, every).join(tested, ["a", "b"], "left_anti")


def _rooted(placed: DataFrame, tested: DataFrame) -> DataFrame:
    """``placed`` with the class that the links so far give each set."""
    linked = tested.where("linked").select("a", "b")
    roots = written(components(linked, most_edges=linked.count()), "roots")
    return placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open_pairs(open_places: DataFrame) -> int:
    """Pairs of different classes in the places, whatever their sizes."""
    by_root = open_places.groupBy("key", "root").agg(F.count("*").cast("double").alias("m"))
    by_key = by_root.groupBy("key").agg(((F.sum("m") * F.sum("m") - F.sum(F.col("m") * F.col("m"))) / 2).alias("p"))
    return int(by_key.agg(F.coalesce(F.sum("p"), F.lit(0.0))).first()[0])


def one_per_class(docs: DataFrame, shingle: int = 5, least: float = 0.8, prints: Prints | None = None, propose: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``docs`` reduced to one row per class of similarity ``least``: the smallest id and, of rows that share
    it, the smallest text hash; of equal rows one. Rows without id come last in this order.

    ``propose`` may name pairs (a, b) of the sets (node, prints) to compare first, from what ``prints`` made of
    their texts. What those connect is not compared again; they change the work, never the classes.
    """
    last = F.lit(NO_ID)
    key = F.struct(F.coalesce("doc_id", last).alias("_sj_id"), F.col("text_hash").alias("_sj_text"))
    marked = marks(docs, shingle, least, common_shingles(docs, shingle), prints)
    own = [F.first(c).alias(c) for c in ("n", "prefix", "flips", "prints")]
    nodes = written(marked.groupBy("node").agg(*own, F.min(key).alias("k")), "nodes")

    def compare(pairs: DataFrame) -> DataFrame:
        return compared(docs, nodes, pairs, shingle, least)

    tested = compare(propose(nodes.select("node", "prints"))) if propose else None
    posted = nodes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    partitions = wide(docs.sparkSession, posted, 1_000_000)
    placed = written(places(nodes, partitions), "places")
    named = placed.withColumn("root", F.col("node")) if tested is None else _rooted(placed, tested)
    first = candidates(named.select(*PLACED), least, partitions, False)
    if tested is not None:
        first = first.join(tested, ["a", "b"], "left_anti")
    linked = links(placed, first, compare, least, partitions, tested)
    roots = components(linked, most_edges=linked.count())
    classes = nodes.select("node", "k").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keepers = classes.groupBy("root").agg(F.min("k").alias("k")).select("k.*")
    # The rows meet on the key, so equal rows are already side by side for the last step.
    keyed = docs.withColumns({"_sj_id": F.coalesce(F.col("doc_id").cast("long"), last), "_sj_text": F.xxhash64("text")})
    kept = keyed.join(keepers, ["_sj_id", "_sj_text"], "left_semi")
    return kept.dropDuplicates(["_sj_id", "_sj_text"]).drop("_sj_id", "_sj_text")
