"""SimHash near-duplicates, with pigeonring filtering of the candidates.

The fingerprint of a text is the bitwise majority of the hashes of its word shingles. Fingerprints
at most ``radius`` bits apart are linked, and linked documents form classes.

One fingerprint finds few pairs whose shingles are four fifths alike, as they differ by ten bits or so
on average. :func:`one_per_class` therefore makes several from the same shingle hashes by further mixing; any
of them may propose a link, and the full sets decide. Similar pairs that no fingerprint brings together are
found by the prefix filter of :mod:`shoplens.llm.set_join`, so that no link is lost.

Candidates: 64 bits are cut into ``radius + 1`` segments on a ring. For any pair within the radius
there is a segment from which every chain of l segments differs in at most l * radius / segments
bits, rounded down: none in the first, one in the first two, and so on. So a fingerprint is posted under
each pair of consecutive segments, and once more for every zero bit of the second segment that the
other side may have set. Longer chains and the full distance are then checked on what meets there.

Defined results: null and empty texts have fingerprint zero and are linked like any other; equal
fingerprints are one node, so copies never form pairs; rows repeated with one ``doc_id`` get a row
each; null ids take part and are never a class's smallest id unless it has no other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import set_join
from shoplens.llm.common import few, slices, texts, wide, written
from shoplens.llm.graph import components, forest
from shoplens.llm.set_join import NO_ID

# Most fingerprints of a document, and shingles worked on at once.
MOST_PRINTS, STEP = 8, 8192
# Above this many members a meeting place is searched node by node instead of pair by pair.
PAIRWISE = 48


def majorities(text: bytes, shingle: int, prints: int = 1, seed: int = 42) -> np.ndarray:
    """Fingerprints of one text as unsigned numbers; every shingle counts, repeats included."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(prints, "uint64")
    buffer = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "int64", n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if n > shingle:
        starts, ends = starts[: n - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_digest, np.zeros(64 * prints, "int64")
    for i in range(0, len(starts), STEP):
        spans = zip(starts[i : i + STEP].tolist(), ends[i : i + STEP].tolist(), strict=True)
        hashes = np.frombuffer(b"".join([digest(buffer[s:e], seed) for s, e in spans]), ">u8")
        mixed = [hashes] + [_remixed(hashes.astype("uint64"), k) for k in range(1, prints)]
        octets = np.stack(mixed, axis=1).astype(">u8").view("uint8")
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype="uint32")
    return np.packbits(2 * ones > len(starts)).view(">u8").astype("uint64")


def _remixed(hashes: np.ndarray, number: int) -> np.ndarray:
    x = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 * (2 * number + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def fingerprints(docs: DataFrame, shingle: int = 5, prints: int = 1) -> DataFrame:
    """(doc_id, text_hash, prints: fingerprints as signed longs) per row, from the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array([majorities(t, shingle, prints).view("int64") for t in texts(batch)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), found], ["doc_id", "text_hash", "prints"])

    plain = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return plain.mapInArrow(run, "doc_id bigint, text_hash bigint, prints array<bigint>")


def segments(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of ``radius + 1`` segments that cover 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(n)]


def _mask(shift: int, width: int) -> np.uint64:
    return np.uint64(((1 << width) - 1) << shift)


def _postings(values: np.ndarray, number: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and fingerprints of the meeting places of ``values``; ``number`` of the print is the
    lowest three bits of a key, so that different prints never meet."""
    ring, keys, owners = segments(radius), [], []
    for i, (shift, width) in enumerate(ring):
        next_shift, next_width = ring[(i + 1) % len(ring)]
        own = values & (_mask(shift, width) | _mask(next_shift, next_width))
        # The chain's number goes into the hash, as keys of other chains may have the same bits.
        salt = np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1)
        for bit in [None, *range(next_shift, next_shift + next_width)]:
            one = np.uint64(0) if bit is None else np.uint64(1 << bit)
            free = slice(None) if bit is None else (values & one) == 0
            mixed = ((own[free] | one) + salt) * np.uint64(0xD6E8FEB86659FD93)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            keys.append(((mixed >> np.uint64(32)) & np.uint64(0xFFFFFFF8)) | number[free])
            owners.append(values[free])
    return np.concatenate(keys).astype("uint32").view("int32"), np.concatenate(owners)


def _near(x: np.ndarray, chain: int, radius: int) -> np.ndarray:
    """Which differences ``x`` are within the radius: chains from segment ``chain`` first, then all bits."""
    ring = segments(radius)
    alive, mask = np.arange(len(x)), np.uint64(0)
    for length in range(1, len(ring) + 1):
        mask |= _mask(*ring[(chain + length - 1) % len(ring)])
        alive = alive[np.bitwise_count(x[alive] & mask) <= length * radius // len(ring)]
    return alive


def _links(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that share a key."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (values[1:] != values[:-1])])
    keys, values = keys[fresh], values[fresh]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(first, len(keys)))
    a, b = [], []
    left = np.repeat(np.where(sizes <= PAIRWISE, sizes, 0), sizes) - (np.arange(len(keys)) - np.repeat(first, sizes))
    for step in range(1, PAIRWISE):
        at = np.flatnonzero(left > step)
        if not len(at):
            break
        x = values[at] ^ values[at + step]
        # Any chain may be the one that kept its budgets: the meeting place tells which, but its key
        # is hashed, so all are tried.
        close = at[np.unique(np.concatenate([_near(x, c, radius) for c in range(radius + 1)]))]
        a.append(values[close])
        b.append(values[close + step])
    for start, size in zip(first[sizes > PAIRWISE], sizes[sizes > PAIRWISE], strict=True):
        for x, y in _spread(values[start : start + size], radius):
            a.append(np.full(len(y), x, "uint64"))
            b.append(y)
    if not a:
        return np.empty(0, "uint64"), np.empty(0, "uint64")
    return np.concatenate(a), np.concatenate(b)


def _nearest(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs, for each value the nearest partner on either side: at most two per value."""
    distance, kept = np.bitwise_count(low ^ high), np.zeros(len(low), bool)
    for own, other in ((low, high), (high, low)):
        order = np.lexsort((other, distance, own))
        kept[order[np.concatenate([[True], own[order][1:] != own[order][:-1]])[: len(order)]]] = True
    pairs = np.unique(np.stack([low[kept], high[kept]]), axis=1)
    return pairs[0], pairs[1]


def _spread(values: np.ndarray, radius: int) -> Iterator[tuple[np.uint64, np.ndarray]]:
    """Links that connect a large meeting place, found breadth first: a node leaves the search when
    it is reached, so a dense group costs far less than its pairs and yields no more links than nodes."""
    rest = values
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= radius
            if near.any():
                yield node, rest[near]
                queue.extend(rest[near])
                rest = rest[~near]


def links(values: DataFrame, radius: int, n_values: int, spanning: bool = True) -> DataFrame:
    """(print, a, b) links between distinct ``values`` (print, fingerprint) that connect all of one
    print that lie within ``radius``; without ``spanning`` pairs that are near themselves: the nearest smaller and the
    nearest larger value that each one meets in a task."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, found = batch.column(0).to_numpy().astype("uint64"), batch.column(1).to_numpy().view("uint64")
            for i in range(0, len(found), 10_000):
                keys, owners = _postings(found[i : i + 10_000], number[i : i + 10_000], radius)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view("int64"))], ["key", "fingerprint"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            keys, found = (np.concatenate(x) for x in zip(*parts, strict=True))
            number = keys & 7
            for k in np.unique(number).tolist():
                a, b = _links(keys[number == k], found[number == k].view("uint64"), radius)
                a, b = forest(a, b) if spanning else _nearest(np.minimum(a, b), np.maximum(a, b))
                columns = [pa.array(np.full(len(a), k, "int32")), pa.array(a.view("int64")), pa.array(b.view("int64"))]
                yield pa.RecordBatch.from_arrays(columns, ["print", "a", "b"])

    posted = values.select("print", "fingerprint").mapInArrow(post, "key int, fingerprint bigint")
    # About 40 postings a fingerprint; a task holds about a million of them.
    spread = posted.repartition(wide(values.sparkSession, 40 * n_values, 1_000_000), "key")
    return spread.mapInArrow(meet, "print int, a bigint, b bigint")


def _values(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Values (print, fingerprint, first) of ``nodes`` (node, prints), and links (a, b) between those that share one:
    the smallest node stands for all."""
    tagged = nodes.select("node", F.posexplode("prints").alias("print", "fingerprint"))
    values = tagged.groupBy("print", "fingerprint").agg(F.min("node").alias("first"))
    values = written(few(values, MOST_PRINTS * nodes.count()), "values")
    shared = tagged.join(values, ["print", "fingerprint"]).where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    return values, shared


def _between_nodes(near: DataFrame, values: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, b) of nodes, a < b, from links ``near`` (print, a, b) of values, and the ``shared`` ones."""
    for side in ("a", "b"):
        place = values.select("print", F.col("fingerprint").alias(side), F.col("first").alias(f"node_{side}"))
        near = near.join(place, ["print", side])
    both = near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).unionByName(shared)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _edges(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b) links that connect all ``nodes`` (node, prints) which are equal or near in any print."""
    values, shared = _values(nodes)
    return _between_nodes(links(values, radius, values.count()), values, shared)


def _proposals(nodes: DataFrame, radius: int) -> DataFrame:
    """(a, b) pairs of ``nodes`` (node, prints) to compare first: of those equal or near in any print, each value's
    nearest on either side, so that they grow with the values. Some links are not among them: whoever calls
    this finds those in another way."""
    values, shared = _values(nodes)
    near = links(values, radius, values.count(), spanning=False)
    # Over all tasks too, each value keeps its nearest partners.
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("d")
    near = written(near.select("print", "a", "b", distance), "near")
    lower = near.groupBy("print", "b").agg(F.min(F.struct("d", "a")).alias("n")).select("print", F.col("n.a").alias("a"), "b")
    upper = near.groupBy("print", "a").agg(F.min(F.struct("d", "b")).alias("n")).select("print", "a", F.col("n.b").alias("b"))
    return _between_nodes(lower.unionByName(upper).distinct(), values, shared)


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 4, prints: int = 1) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row; ``component_id`` is the smallest ``doc_id`` that
    links reach. The texts are read once; all else works on the written fingerprints."""
    marked, nodes = _nodes(docs, shingle, prints)
    if prints == 1:
        edges = links(nodes.select(F.lit(0).alias("print"), F.col("node").alias("fingerprint")), radius, nodes.count())
    else:
        edges = _edges(nodes, radius)
    placed = nodes.select("node", "k").join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("k._sd_id").alias("least")).select("root", F.when(F.col("least") != NO_ID, F.col("least")).alias("component_id"))
    found = marked.join(placed.select("node", "root").join(least, "root"), "node")
    return found.select("doc_id", F.element_at("prints", 1).alias("fingerprint"), "component_id")


def _nodes(docs: DataFrame, shingle: int, prints: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, prints, node), and nodes (node, prints, k: smallest id and text hash)."""
    if not 1 <= prints <= MOST_PRINTS:
        raise ValueError(f"prints must be 1 to {MOST_PRINTS}")
    # One fingerprint is its own node; several are named by their 64-bit hash.
    node = F.element_at("prints", 1) if prints == 1 else F.xxhash64("prints")
    marked = written(fingerprints(docs, shingle, prints).withColumn("node", node), "fingerprints")
    key = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("_sd_id"), F.col("text_hash").alias("_sd_text"))
    return marked, written(marked.groupBy("node").agg(F.first("prints").alias("prints"), F.min(key).alias("k")), "nodes")


def one_per_class(docs: DataFrame, shingle: int = 5, radius: int = 6, prints: int = 4, similarity: float = 0.8) -> DataFrame:
    """``docs`` reduced to one row per class: the smallest id and, of rows that share it, the smallest
    text hash; of equal rows one. Rows without id come last in this order.

    Linked is every pair whose sets of shingles reach ``similarity`` (Jaccard), and nothing below it. Pairs of
    nearest fingerprints within the radius are compared first; the exact join then compares what
    their links leave apart. Null and empty texts are one class.
    """
    if not 1 <= prints <= MOST_PRINTS:
        raise ValueError(f"prints must be 1 to {MOST_PRINTS}")

    def of_text(text: bytes) -> np.ndarray:
        return majorities(text, shingle, prints).view("int64")

    def propose(nodes: DataFrame) -> DataFrame:
        return _proposals(nodes, radius)

    return set_join.one_per_class(docs, shingle, similarity, of_text, propose)
