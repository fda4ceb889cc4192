"""Boosted trees for a binary label, grown leaf by leaf from distributed histograms.

Features are binned once into a byte each and written as one packed column. For a tree, every job sums
gradients, hessians and rows per (node, feature, bin): tasks keep one array per node, a second stage adds
them up, and the driver gets the sums alone, whose size depends on leaves, features and bins, never on
rows. Of two children only the smaller is summed; the other is its parent less the smaller.

Trees are the best-first trees of a leaf limit, with about one job per depth instead of one per leaf: all nodes
that may still be among the splits are opened together, and what the limit crowds out is closed at the end. Sums are whole numbers of 1 / ``UNIT``, so trees do not
depend on partitions or on the order of addition.

Margins are kept beside the bins. A job adds the latest trees to them, and every ``KEEP`` rounds the table is
written anew, so a job evaluates few trees, and lost executors cost one scan.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.session import HandOver

# Workers need no copy of this module on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The objective of the reference run's learner.
RATE, LEAVES, DEPTH, L1, L2 = 0.05, 50, 8, 10.0, 2.0
COLUMN_SHARE, SEED, BINS = 0.2, 100, 255
LEAST_ROWS, LEAST_HESSIAN = 20, 1e-3
# Rows (expected number) from which the edges of bins are taken; gradients count in units of 1 / UNIT.
EDGE_ROWS, UNIT = 20_000, 1 << 24
# Rounds between two written tables of margins; features whose sums travel in one row.
KEEP, CHUNK = 20, 16


@dataclass(frozen=True)
class Objective:
    """What a tree may look like. ``rate`` shrinks leaf values, ``l1`` and ``l2`` enter gains and values."""

    rate: float = RATE
    leaves: int = LEAVES
    depth: int = DEPTH
    l1: float = L1
    l2: float = L2
    column_share: float = COLUMN_SHARE
    seed: int = SEED
    least_rows: int = LEAST_ROWS
    least_hessian: float = LEAST_HESSIAN

    def __post_init__(self) -> None:
        if self.leaves < 1 or not 1 <= self.depth <= 30 or not 0 < self.column_share <= 1:
            raise ValueError("a tree needs a leaf, 1 to 30 levels and a share of the columns")


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has ``left`` -1. Rows whose value is at most ``threshold`` (whose bin is at
    most ``bin``) go left."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaf_of(self, values: np.ndarray, limit: np.ndarray) -> np.ndarray:
        at, every = np.zeros(len(values), "int64"), np.arange(len(values))
        while True:
            inner = self.left[at] >= 0
            if not inner.any():
                return at
            low = values[every, self.feature[at]] <= limit[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins, self.bin)]

    def of_values(self, values: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(values, self.threshold)]


@dataclass(frozen=True)
class Boosted:
    """Trees in order of growth; a model of fewer rounds is a prefix of them."""

    features: list[str]
    start: float
    trees: list[Tree]


@dataclass
class _Node:
    number: int
    depth: int
    sums: np.ndarray | None  # features x bins x (gradient, hessian, rows), whole units
    totals: np.ndarray
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    children: list["_Node"] = field(default_factory=list)


def bin_edges(sample: DataFrame, features: list[str], bins: int = BINS, rows: int = EDGE_ROWS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, from about ``rows`` rows chosen by the hash of their
    other columns, such as keys (of all, if there are none but the features and one more): midway between distinct values if there are few, else quantiles."""
    if not 2 <= bins <= 256:
        raise ValueError("a bin is a byte")
    total, slots = sample.count(), 1 << 30
    cut = slots if total <= rows else int(slots * (rows / total))
    others = [c for c in sample.columns if c not in set(features)]
    named = others if len(others) > 1 else sample.columns
    # A limit for tables in which most rows are equal in these columns.
    chosen = sample.where(F.pmod(F.xxhash64(*named), F.lit(slots)) < cut).limit(2 * rows).select(_packed_values(features))
    parts = [F.struct(F.lit(i).alias("chunk"), F.slice("values", i + 1, CHUNK).alias("values")) for i in range(0, len(features), CHUNK)]

    def found(group: pa.Table) -> pa.Table:
        first = group.column("chunk")[0].as_py()
        edges = [_edges(column, bins) for column in _matrix(group.column("values"), min(CHUNK, len(features) - first)).T]
        return pa.table({"feature": pa.array(range(first, first + len(edges)), pa.int32()), "edges": pa.array(edges, pa.list_(pa.float64()))})

    # Executors sort the values, a few features each; the driver gets the edges alone.
    tall = chosen.select(F.inline(F.array(*parts)))
    table = tall.groupBy("chunk").applyInArrow(found, "feature int, edges array<double>").toArrow()
    edges = [np.empty(0) for _ in features]
    for i, own in zip(*(table.column(c).to_pylist() for c in ("feature", "edges")), strict=True):
        edges[i] = np.array(own)
    return edges


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    distinct = np.unique(column)
    if len(distinct) <= bins:
        return (distinct[1:] + distinct[:-1]) / 2
    inner = np.quantile(column, np.arange(1, bins) / bins, method="inverted_cdf")
    return np.unique(inner[inner < distinct[-1]])


def _packed_values(features: list[str]):
    """One array of doubles instead of hundreds of columns."""
    return F.array(*[F.col(f).cast("double") for f in features]).alias("values")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Packed values as a matrix; null and NaN count as zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return np.where(np.isnan(values), 0.0, values)


def _bins(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "uint8").reshape(-1, width)


def binned(sample: DataFrame, features: list[str], edges: list[np.ndarray], label: str, start: float) -> DataFrame:
    """(bins, label, margin): a byte per feature."""
    width = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("values"), width)
            out = np.empty(values.shape, "uint8")
            for i, edge in enumerate(edges):
                out[:, i] = np.searchsorted(edge, values[:, i], side="left")
            columns = [pa.array([r.tobytes() for r in out], pa.binary()), batch.column("label"), pa.array(np.full(len(out), start))]
            yield pa.RecordBatch.from_arrays(columns, ["bins", "label", "margin"])

    return sample.select(_packed_values(features), F.col(label).cast("double").alias("label")).mapInArrow(run, "bins binary, label double, margin double")


def _advanced(rows: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """``rows`` with ``trees`` added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, margin = _bins(batch.column("bins"), width), batch.column("margin").to_numpy().copy()
            for tree in trees:
                margin += tree.of_bins(bins)
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), pa.array(margin)], ["bins", "label", "margin"])

    return rows.mapInArrow(run, "bins binary, label double, margin double")


def histograms(rows: DataFrame, trees: list[Tree], part: Tree, wanted: list[int], columns: np.ndarray, width: int) -> np.ndarray:
    """(node, feature, bin, 3) sums of gradients, hessians and rows over the leaves ``wanted`` of ``part``."""
    shape = (len(wanted), len(columns), 256, 3)
    place = np.full(len(part.left), -1)
    place[wanted] = np.arange(len(wanted))
    chunks = -(-len(columns) // CHUNK)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, "int64")
        for batch in batches:
            bins, margin = _bins(batch.column("bins"), width), batch.column("margin").to_numpy().copy()
            for tree in trees:
                margin += tree.of_bins(bins)
            node = place[part.leaf_of(bins, part.bin)]
            kept = np.flatnonzero(node >= 0)
            if not len(kept):
                continue
            chance = 1 / (1 + np.exp(-margin[kept]))
            gradient = np.rint((chance - batch.column("label").to_numpy()[kept]) * UNIT)
            hessian = np.rint(chance * (1 - chance) * UNIT)
            own, base = np.ascontiguousarray(bins[np.ix_(kept, columns)].T), node[kept] * 256
            for i in range(len(columns)):
                slot = base + own[i]
                for k, weight in enumerate((gradient, hessian, None)):
                    sums[:, i, :, k] += np.bincount(slot, weight, 256 * len(wanted)).astype("int64").reshape(-1, 256)
        yield _rows([(n, c, _sparse(sums[n, c * CHUNK : (c + 1) * CHUNK])) for n in range(len(wanted)) for c in range(chunks)])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for n, c, sums in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (n, c) not in held:
                    held[n, c] = np.zeros((min(CHUNK, len(columns) - c * CHUNK), 256, 3), "int64")
                _add(held[n, c], sums)
        yield _rows([(n, c, _sparse(sums)) for (n, c), sums in held.items()])

    kind = "node int, chunk int, sums binary"
    total = rows.mapInArrow(summed, kind).repartition("node", "chunk").mapInArrow(added, kind).toArrow()
    out = np.zeros(shape, "int64")
    for n, c, sums in zip(*(total.column(x).to_pylist() for x in ("node", "chunk", "sums")), strict=True):
        _add(out[n, c * CHUNK : (c + 1) * CHUNK], sums)
    return out


def _sparse(sums: np.ndarray) -> bytes:
    """Sums of the bins that hold rows: their numbers, then the values."""
    flat = sums.reshape(-1, 3)
    held = np.flatnonzero(flat[:, 2])
    return np.int64(len(held)).tobytes() + held.astype("int64").tobytes() + flat[held].tobytes()


def _add(sums: np.ndarray, sparse: bytes) -> None:
    found = np.frombuffer(sparse, "int64")
    n = int(found[0])
    sums.reshape(-1, 3)[found[1 : n + 1]] += found[n + 1 :].reshape(-1, 3)


def _rows(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    node, chunk, sums = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(chunk, pa.int32()), pa.array(sums, pa.binary())], ["node", "chunk", "sums"])


def _soft(gradient: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0)


def _quality(gradient: np.ndarray, hessian: np.ndarray, o: Objective) -> np.ndarray:
    return _soft(gradient, o.l1) ** 2 / (hessian + o.l2)


def split_gains(sums: np.ndarray, o: Objective) -> np.ndarray:
    """(feature, bin) gain of splitting a node after each bin; minus infinity where a side has too little."""
    left = np.cumsum(sums, axis=1)
    total = left[:, -1:, :]
    with np.errstate(all="ignore"):
        (gl, hl, nl), (g, h, n) = ((x[..., 0] / UNIT, x[..., 1] / UNIT, x[..., 2]) for x in (left, total))
        gain = _quality(gl, hl, o) + _quality(g - gl, h - hl, o) - _quality(g, h, o)
    fits = (nl >= o.least_rows) & (n - nl >= o.least_rows) & (hl >= o.least_hessian) & (h - hl >= o.least_hessian)
    return np.where(fits, gain, -np.inf)


def _judged(node: _Node, columns: np.ndarray, o: Objective) -> None:
    """Set the node's best split: the largest gain, of equal ones the first feature and bin."""
    gains = split_gains(node.sums, o)
    best = int(np.argmax(gains)) if gains.size else 0
    if node.depth < o.depth and gains.size and gains.flat[best] > 0:
        place, node.bin = divmod(best, 256)
        node.gain, node.feature = float(gains.flat[best]), int(columns[place])


def _arranged(root: _Node, opened: set[int], edges: list[np.ndarray], o: Objective) -> tuple[Tree, dict[int, int]]:
    """The tree whose inner nodes are ``opened``, and the place of each node in its arrays."""
    order, queue = [], [root]
    while queue:
        node = queue.pop(0)
        order.append(node)
        queue += node.children if node.number in opened else []
    place = {node.number: i for i, node in enumerate(order)}
    inner = [node.number in opened for node in order]
    totals = np.array([node.totals for node in order], "float64") / UNIT
    tree = Tree(
        feature=np.array([n.feature if i else 0 for n, i in zip(order, inner, strict=True)], "int64"),
        bin=np.array([n.bin if i else 0 for n, i in zip(order, inner, strict=True)], "int64"),
        threshold=np.array([edges[n.feature][n.bin] if i else 0.0 for n, i in zip(order, inner, strict=True)], "float64"),
        left=np.array([place[n.children[0].number] if i else -1 for n, i in zip(order, inner, strict=True)], "int64"),
        right=np.array([place[n.children[1].number] if i else -1 for n, i in zip(order, inner, strict=True)], "int64"),
        value=-o.rate * _soft(totals[:, 0], o.l1) / (totals[:, 1] + o.l2 + 1e-300),
        gain=np.array([n.gain if i else 0.0 for n, i in zip(order, inner, strict=True)], "float64"),
    )
    return tree, place


def grow(rows: DataFrame, trees: list[Tree], columns: np.ndarray, edges: list[np.ndarray], o: Objective) -> Tree:
    """The next tree, from ``rows`` whose margins lack ``trees``."""
    width = len(edges)
    root = _Node(0, 0, None, np.zeros(3, "int64"))
    known, opened = [root], set()
    alone, _ = _arranged(root, opened, edges, o)
    root.sums = histograms(rows, trees, alone, [0], columns, width)[0]
    root.totals = root.sums[0].sum(axis=0)
    _judged(root, columns, o)
    while True:
        fresh = [n for n in _first_splits(root, o.leaves - 1) if n.number not in opened]
        if not fresh:
            break
        smaller = []
        for node in fresh:
            left = node.sums[int(np.flatnonzero(columns == node.feature)[0]), : node.bin + 1].sum(axis=0)
            for totals in (left, node.totals - left):
                node.children.append(_Node(len(known), node.depth + 1, None, totals))
                known.append(node.children[-1])
            opened.add(node.number)
            smaller.append(min(node.children, key=lambda c: c.totals[2]))
        # Children at the last depth are leaves, so their sums are not needed.
        summed = [(n, s) for n, s in zip(fresh, smaller, strict=True) if s.depth < o.depth]
        if summed:
            part, place = _arranged(root, opened, edges, o)
            sums = histograms(rows, trees, part, [place[s.number] for _, s in summed], columns, width)
            for (node, small), own in zip(summed, sums, strict=True):
                for child in node.children:
                    child.sums = own if child is small else node.sums - own
                    _judged(child, columns, o)
        for node in fresh:
            node.sums = None
    return _arranged(root, {n.number for n in _first_splits(root, o.leaves - 1)}, edges, o)[0]


def _first_splits(root: _Node, most: int) -> list[_Node]:
    """The first nodes to be split if the best leaf always is next, as far as nodes are known: children still
    unknown can only crowd others out, so what is needed in the end is always among these."""
    chosen: list[_Node] = []
    heap = [(-root.gain, 0, root)] if root.feature >= 0 else []
    while heap and len(chosen) < most:
        chosen.append(heapq.heappop(heap)[2])
        for child in chosen[-1].children:
            if child.feature >= 0:
                heapq.heappush(heap, (-child.gain, child.number, child))
    return chosen


def train(
    sample: DataFrame, features: list[str], rounds: int, label: str = "flag", objective: Objective = Objective(),
    edges: list[np.ndarray] | None = None,
) -> Boosted:
    """``rounds`` trees on ``sample``; null features count as zero. The first margin is the log odds of
    the label; a sample without both labels gives a model without trees."""
    edges = bin_edges(sample, features) if edges is None else edges
    n, positive = sample.agg(F.count("*"), F.sum(F.col(label).cast("double"))).first()
    if not n or not 0 < (positive or 0) < n:
        share = (positive or 0) / n if n else 0.5
        return Boosted(features, float(np.log((share + 1e-15) / (1 - share + 1e-15))), [])
    start = float(np.log(positive / (n - positive)))
    usable = np.flatnonzero([len(e) for e in edges])
    if not len(usable):
        return Boosted(features, start, [])
    picked = min(len(usable), max(1, round(objective.column_share * len(features))))
    store, trees, pending = HandOver(sample.sparkSession), [], []
    try:
        # Even parts, as the matrix may come in few files.
        parts = sample.sparkSession.sparkContext.defaultParallelism
        rows = store.put("rows", binned(sample, features, edges, label, start).repartition(parts))
        for number in range(rounds):
            columns = np.sort(np.random.default_rng((objective.seed, number)).choice(usable, picked, replace=False))
            trees.append(grow(rows, pending, columns, edges, objective))
            pending.append(trees[-1])
            if len(pending) == KEEP:
                following = HandOver(sample.sparkSession)
                rows, before, store = following.put("rows", _advanced(rows, pending, len(features))), store, following
                before.close()
                pending = []
    finally:
        store.close()
    return Boosted(features, start, trees)


def staged_probabilities(model: Boosted, sample: DataFrame, rounds: tuple[int, ...]) -> DataFrame:
    """``sample`` without its features, with ``probability_<i>`` after each number of rounds, from one
    walk along the trees; more rounds than the model has give its last margin."""
    kept = [c for c in sample.columns if c not in set(model.features)]
    names = [f"probability_{i}" for i in range(len(rounds))]
    sent = sample.sparkSession.sparkContext.broadcast([tuple(vars(t).values()) for t in model.trees])
    start, width, stops = model.start, len(model.features), list(rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(*t) for t in sent.value]
        for batch in batches:
            values = _matrix(batch.column("values"), width)
            margin, found = np.full(len(values), start), {}
            for number in range(max(stops) + 1):
                if number in stops:
                    found[number] = 1 / (1 + np.exp(-margin))
                if number < len(trees):
                    margin += trees[number].of_values(values)
            columns = [batch.column(c) for c in kept] + [pa.array(found[r]) for r in stops]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    plain = sample.select(*kept, _packed_values(model.features))
    kinds = [f"`{c}` {kind}" for c, kind in plain.dtypes if c != "values"] + [f"{c} double" for c in names]
    return plain.mapInArrow(run, ", ".join(kinds))
