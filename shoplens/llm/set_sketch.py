"""Near duplicates by SetSketch registers: bands of registers propose, the joint likelihood sifts, full sets decide.

Each distinct set of word shingles gets ``REGISTERS`` registers. A register keeps the smallest of the
exponentially distributed values that its hash gives the set's shingles, as the exponent of the power of
``BASE`` below it, cut to 16 bits; the registers of a union are the larger of each pair. Registers of similar
sets agree often, so ``BANDS`` bands of ``BAND`` registers each are meeting places: two sets of Jaccard similarity
0.85 meet in none with a probability of 2e-8.

Of sets that meet, the similarity is estimated by maximum likelihood from how many registers are larger on
either side or equal, given the sets' sizes. Pairs whose estimate is six standard errors below the bound are
dropped (1e-9 of those at the bound); all others are verified on the full sets.

In each meeting place one set, the hub, is first compared with all others, which connects copies of one
text at about one comparison per set and place. Places whose sets are then of several classes are compared
in blocks of bounded size: a block of sets outside the place's largest class with each of its blocks, all by
registers, each pair at the first place that both share, and what is likely by full sets. A block returns the
links that connect its classes, so no pairs within a group are spelt out, and none is left out.

Defined results: null texts and texts without words have empty sets and stay alone; fewer words than a
shingle make one shingle; shingles are known by 64-bit hashes; equal sets are one node; rows repeated with
one ``doc_id`` get a row each; null ids take part and name a class only if it has no other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slices, texts, written
from shoplens.llm.graph import components
from shoplens.llm.set_join import _lists, _nodes, sets_of, shingle_sets

BANDS, BAND = 30, 5
REGISTERS = BANDS * BAND
# The sketch's base, rate and largest register, as in the paper's 16-bit example.
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 1
SLICE_BYTES = 1 << 20
ERRORS = 6.0
# Most sets and bytes of a block.
BLOCK_SETS, BLOCK_BYTES = 1024, 8 << 20


def smallest_hashes(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, REGISTERS) smallest hash of each set under each register's hash function; sets are not empty."""
    sizes = np.bincount(owner, minlength=n)
    starts = np.cumsum(sizes) - sizes
    own, out = hashes.view("uint64"), np.empty((n, REGISTERS), "uint64")
    x, y = np.empty_like(own), np.empty_like(own)
    for i in range(REGISTERS):
        salt = (0x9E3779B97F4A7C15 * (i + 1)) & (1 << 64) - 1
        np.bitwise_xor(own, np.uint64(salt), out=x)
        np.multiply(x, np.uint64(0xBF58476D1CE4E5B9), out=x)
        np.right_shift(x, np.uint64(31), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint64(0x94D049BB133111EB), out=x)
        out[:, i] = np.minimum.reduceat(x, starts)
    return out


def registers(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, REGISTERS) SetSketch registers. The exponential value grows with the hash, so the smallest
    hash gives the smallest value."""
    unit = (smallest_hashes(hashes, owner, n).astype("float64") + 0.5) / 2.0**64
    value = -np.log1p(-np.minimum(unit, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, LARGEST).astype("uint16")


def bands(sketch: np.ndarray) -> np.ndarray:
    """(n, BANDS) meeting places of sketches, as 64-bit hashes of the band's number and registers."""
    parts = sketch.reshape(len(sketch), BANDS, BAND).astype("uint64")
    key = np.arange(1, BANDS + 1, dtype="uint64")[None, :] * np.uint64(0x9E3779B97F4A7C15)
    key = np.repeat(key, len(sketch), axis=0)
    for i in range(BAND):
        key = (key ^ parts[:, :, i]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view("int64")


def slopes(larger: np.ndarray, smaller: np.ndarray, registers_: int, u: np.ndarray, j: np.ndarray | float) -> np.ndarray:
    """Derivative, at similarity ``j``, of the log-likelihood of how many registers are larger or smaller in
    the first of two sets, which holds a share ``u`` of both sets' elements. The likelihood is concave, so the
    estimate is above ``j`` exactly where this is positive."""
    v, share = 1 - u, (BASE - 1) / BASE
    x, y = u - v * j, v - u * j
    dx, dy = -v * share / (1 - x * share), -u * share / (1 - y * share)
    p, q = -np.log1p(-x * share), -np.log1p(-y * share)
    return larger * dx / p + smaller * dy / q - (registers_ - larger - smaller) * (dx + dy) / (np.log(BASE) - p - q)


def estimates(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of each pair of sketches, given the sizes of the sets."""
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u = size_a / (size_a + size_b)
    low, high = np.zeros(len(a)), np.minimum(u / (1 - u), (1 - u) / u)
    with np.errstate(all="ignore"):
        for _ in range(30):
            middle = (low + high) / 2
            up = slopes(larger, smaller, a.shape[1], u, middle) > 0
            low, high = np.where(up, middle, low), np.where(up, high, middle)
    return high


def lowest_estimate(least: int) -> float:
    """Estimate below which a pair is dropped."""
    bound = least / 100
    return bound - ERRORS * (bound * (1 - bound) / REGISTERS) ** 0.5


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, node, n, sketch) per row, from the whole text; empty sets have no sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SLICE_BYTES):
            rows = batch.num_rows
            hashes, owner = shingle_sets(texts(batch), shingle)
            sizes, some = np.bincount(owner, minlength=rows), np.unique(owner)
            made: list[bytes | None] = [None] * rows
            if len(some):
                for i, sketch in zip(some.tolist(), registers(hashes, np.searchsorted(some, owner), len(some)), strict=True):
                    made[i] = sketch.tobytes()
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(_nodes(hashes, owner, rows)), pa.array(sizes), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "n", "sketch"])

    plain = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return plain.mapInArrow(run, "doc_id bigint, text_hash bigint, node bigint, n bigint, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "uint16").reshape(len(column), REGISTERS)


def meetings(nodes: DataFrame) -> DataFrame:
    """(key, node) for every band of registers that several nodes share."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = bands(_matrix(batch.column("sketch")))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS))], ["key", "node"])

    posted = written(nodes.select("node", "sketch").mapInArrow(post, "key bigint, node bigint"), "posted")
    met = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return posted.join(met, "key")


def sifted(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """(a, b, estimate) of the pairs whose estimated similarity allows for ``least`` percent."""
    lowest = lowest_estimate(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = [batch.column(c).to_numpy().astype("float64") for c in ("n_a", "n_b")]
                found = estimates(_matrix(batch.column("sketch_a")), _matrix(batch.column("sketch_b")), *sizes)
                kept = pa.array(found >= lowest)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], ["a", "b", "estimate"]).filter(kept)

    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(own, side)
    # Of sets of such different sizes none is similar enough.
    near = pairs.where(100 * F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b"))
    return near.mapInArrow(run, "a bigint, b bigint, estimate double")


def verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b, linked): whether the full sets have a similarity of ``least`` percent."""
    for side, name in (("a", "x"), ("b", "y")):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(name)), side)
    both = F.size(F.array_intersect("x", "y"))
    return pairs.select("a", "b", (100 * both >= least * (F.size("x") + F.size("y") - both)).alias("linked"))


def _other_classes(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that no link connects yet."""
    for side in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return pairs.where(apart).drop("root_a", "root_b")


def blocks(named: DataFrame) -> DataFrame:
    """(key, low, high, block, node): each set of a place (key, node, root, n) with the pairs of blocks that it
    takes part in. The largest class of a place has blocks of its own, which do not meet each other."""
    sizes = named.groupBy("key", "root").agg(F.count("*").alias("sets"), F.sum(8 * F.col("n") + 2 * REGISTERS).alias("bytes"))
    needed = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("bytes") / BLOCK_BYTES))
    largest = F.max(F.struct("sets", "root", "bytes")).alias("main")
    places = sizes.groupBy("key").agg(largest, F.sum("sets").alias("sets"), F.sum("bytes").alias("bytes"))
    others = places.select("key", "main", (F.col("sets") - F.col("main.sets")).alias("sets"), (F.col("bytes") - F.col("main.bytes")).alias("bytes"))
    counted = others.select("key", "main", needed.alias("others")).select(
        "key", "others", F.col("main.root").alias("main_root"), F.col("main.sets").alias("sets"), F.col("main.bytes").alias("bytes")
    ).select("key", "others", "main_root", needed.alias("mains"))
    part = F.xxhash64("node", F.lit("block"))
    main = F.col("root") == F.col("main_root")
    block = F.when(main, F.col("others") + F.pmod(part, "mains")).otherwise(F.pmod(part, "others"))
    placed = named.join(counted, "key").withColumn("block", block)
    last = F.when(main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return met.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root")


def _compared(rows: pa.Table, least: int) -> tuple[list[int], list[int]]:
    """Links between the classes of the sets of two blocks of one place."""
    key, low, high = (rows.column(c)[0].as_py() for c in ("key", "low", "high"))
    node, root, block = (rows.column(c).to_numpy() for c in ("node", "root", "block"))
    classes = np.unique(root, return_inverse=True)[1]
    if classes.max(initial=0) == 0:
        return [], []
    sketch = _matrix(rows.column("sketch").combine_chunks())
    keys, n, lists = bands(sketch), rows.column("n").to_numpy(), rows.column("shingles").combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
    lowest, a, b = lowest_estimate(least), [], []
    for i in np.flatnonzero(block == low):
        at = np.flatnonzero((block == high) & (classes != classes[i]))
        at = at[at > i] if low == high else at
        at = at[100 * np.minimum(n[at], n[i]) >= least * np.maximum(n[at], n[i])]
        # Each pair at the first band that both share.
        shared = keys[at] == keys[i]
        at = at[keys[i][shared.argmax(axis=1)] == key]
        if len(at):
            larger, smaller = (sketch[i] > sketch[at]).sum(axis=1), (sketch[i] < sketch[at]).sum(axis=1)
            with np.errstate(all="ignore"):
                slope = slopes(larger, smaller, REGISTERS, n[i] / (n[i] + n[at]), lowest)
            # Where sizes alone put the similarity at its bound, the slope is not defined.
            at = at[~(slope < 0)]
        if len(at):
            own, sizes = flat[ends[i] : ends[i + 1]], n[at]
            others = np.concatenate([flat[ends[j] : ends[j + 1]] for j in at])
            hit = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
            both = np.add.reduceat(hit.astype("int64"), np.cumsum(sizes) - sizes)
            for j in at[100 * both >= least * (n[i] + sizes - both)]:
                if classes[j] != classes[i]:
                    classes[classes == classes[j]] = classes[i]
                    a.append(int(node[i]))
                    b.append(int(node[j]))
    return a, b


def block_links(met: DataFrame, nodes: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b) links that connect all similar sets which share a pair of blocks of ``met``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(table: pa.Table) -> pa.RecordBatch:
            a, b = _compared(table, least)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            names = [held.column(c).to_numpy() for c in ("key", "low", "high")]
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
            start = 0
            for end in cuts.tolist():
                yield found(held.slice(start, end - start))
                start = end
            held = held.slice(start)
        if held is not None:
            yield found(held)

    full = met.join(nodes.select("node", "n", "sketch"), "node").join(sets, "node")
    dealt = full.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.select("key", "low", "high", "block", "node", "root", "n", "sketch", "shingles").mapInArrow(run, "a bigint, b bigint")


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of the nodes ``wanted``, and of some others, written."""
    rows = nodes.join(wanted.distinct(), "node", "left_semi").select(F.col("least_id").alias("doc_id"), "text_hash")
    return written(sets_of(docs, rows, shingle), "sets")


def links(docs: DataFrame, nodes: DataFrame, shingle: int, least: int) -> DataFrame:
    """(node, root): classes of the nodes that links of ``least`` percent connect, of nodes with a link."""
    met = written(meetings(nodes), "meetings")
    # One hub per place, the smallest name, so that places of one group choose the same.
    hubs = written(met.groupBy("key").agg(F.min("node").alias("hub")), "hubs")
    others = written(met.join(hubs, "key").where("node <> hub"), "others")
    pairs = written(others.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    likely = written(sifted(pairs, nodes, least), "likely")
    sets = _sets(docs, nodes, likely.select(F.explode(F.array("a", "b")).alias("node")), shingle)
    # First each set's likeliest hub; then the hubs that this leaves apart.
    best = likely.groupBy("b").agg(F.max(F.struct("estimate", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    linked = written(verified(best, sets, least).where("linked").select("a", "b"), "links")
    roots = written(components(linked), "roots")
    rest = _other_classes(likely.select("a", "b").join(best, ["a", "b"], "left_anti"), roots)
    linked = linked.unionByName(written(verified(rest, sets, least).where("linked").select("a", "b"), "more_links"))
    roots = written(components(linked), "roots")
    # What is left: sets of several classes in one place, without its hub.
    named = others.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    named = named.join(mixed, "key", "left_semi").join(nodes.select("node", "n"), "node")
    named = written(named, "named")
    if named.isEmpty():
        return roots
    sets = _sets(docs, nodes, named.select("node"), shingle)
    found = written(block_links(blocks(named), nodes, sets, least), "block_links")
    return components(linked.unionByName(found))


def near_duplicates(docs: DataFrame, shingle: int = 5, least: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row: documents whose sets of shingles have a Jaccard
    similarity of ``least`` percent or more are linked; ``component_id`` is the smallest id that links reach."""
    if not 50 <= least <= 100:
        raise ValueError("least must be 50 to 100 percent")
    rows = written(sketches(docs, shingle), "sketches")
    last = F.lit(int(np.iinfo("int64").max))
    key = F.struct(F.coalesce("doc_id", last).alias("least_id"), "text_hash", "n", "sketch")
    nodes = rows.where("n > 0").groupBy("node").agg(F.min(key).alias("k")).select("node", "k.*")
    nodes = written(nodes, "nodes")
    roots = links(docs, nodes, shingle, least)
    placed = nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    placed = written(placed.select("node", "root").join(names, "root").select("node", "component_id"), "classes")
    joined = rows.select("doc_id", "node", F.col("n").alias("n_shingles")).join(placed, "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("component_id") != last, F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
