"""Merkle manifest of a dataset: a tree of digests per group of rows, and one over the groups' roots.

Rows are leaves, in order within their group. On each level ``arity`` consecutive nodes form a run; every
node finds the others of its run by equijoins of the level with itself on computed indices (XOR for pairs,
else one join per offset of the slot), and the node in slot zero emits the run's parent. The steps of a
level are kept: downwards, each node's path to the top is its own step before its parent's path, so all
levels together handle twice the leaves, however many levels there are.

The digest H is the lowercase hex SHA-256 of its inputs' concatenation, digests being inputs as hex text.

Defined results: a null field is hashed as ``-``, any other as its length in bytes, a colon and its text;
the group of nulls comes first, other groups follow by their bytes; within a group null order values come
first, and rows that are equal in it follow by their leaf; a last run may be short, down to one node, whose
parent is the digest of that node alone; a lone leaf is its group's root, a lone group's root the root; an
empty table gives no rows. Columns of the rows stay, unless they are named like the added ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import written
from shoplens.llm.ordering import numbered

ADDED = ("subroot", "root", "path")
PATH = "array<struct<before:binary,after:binary>>"
NODE = ("_mk_tree", "_mk_idx", "_mk_n", "_mk_hash")


def field(value: Column) -> Column:
    """A field as it enters the digest of its row."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """H of the parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, step: digest(_hex(step["before"]), h, _hex(step["after"])))


def proof(path: Column) -> Column:
    """H of all siblings on a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(_hex(step["before"]), _hex(step["after"]))), ""))


def _steps(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` of one level with the digests of their run before and after them, as ``_mk_step``."""
    idx = F.col("_mk_idx")
    slot = idx % arity
    joined, found = nodes, []
    for offset in range(1, arity):
        index = idx.bitwiseXOR(F.lit(1)) if arity == 2 else idx - slot + (slot + offset) % arity
        name = f"_mk_sibling_{offset}"
        other = nodes.select("_mk_tree", F.col("_mk_idx").alias("_mk_at"), F.col("_mk_hash").alias(name))
        joined = joined.withColumn("_mk_at", index).join(other, ["_mk_tree", "_mk_at"], "left").drop("_mk_at")
        found.append(F.struct(((slot + offset) % arity).alias("slot"), _hex(F.col(name)).alias("hash")))
    # Slots in order; a run may lack its last ones.
    run = F.array_sort(F.filter(F.array(*found), lambda s: s["hash"].isNotNull()))

    def side(wanted) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter(run, wanted), lambda s: s["hash"]), ""))

    step = F.struct(side(lambda s: s["slot"] < slot).alias("before"), side(lambda s: s["slot"] > slot).alias("after"))
    return joined.withColumn("_mk_step", step).drop(*[f"_mk_sibling_{o}" for o in range(1, arity)])


def _climb(nodes: DataFrame, arity: int) -> tuple[DataFrame, DataFrame]:
    """Roots (_mk_tree, _mk_hash) of all trees, and the leaves ``nodes`` with their ``path``.

    Each level is a written table, so the largest joins are those of the leaves, and upper levels are
    broadcast by their exact size.
    """
    largest = nodes.agg(F.max("_mk_n")).first()[0] or 0
    roots, steps = [nodes.where("_mk_n = 1")], []
    level = nodes
    while largest > 1:
        steps.append(written(_steps(level.where("_mk_n > 1"), arity), f"steps_{len(steps)}"))
        first = steps[-1].where(F.col("_mk_idx") % arity == 0)
        parent = F.unhex(digest(_hex(F.col("_mk_hash")), _hex(F.col("_mk_step.after"))))
        count = F.floor((F.col("_mk_n") + (arity - 1)) / arity)
        level = first.select("_mk_tree", F.floor(F.col("_mk_idx") / arity).alias("_mk_idx"), count.alias("_mk_n"), parent.alias("_mk_hash"))
        level = written(level, f"level_{len(steps)}")
        roots.append(level.where("_mk_n = 1"))
        largest = -(-largest // arity)
    above = None
    for number in reversed(range(len(steps))):
        own, rest = F.array("_mk_step"), F.array().cast(PATH)
        at = steps[number]
        if above is not None:
            on = above.select("_mk_tree", F.col("_mk_idx").alias("_mk_up"), F.col("path").alias("_mk_rest"))
            at = at.withColumn("_mk_up", F.floor(F.col("_mk_idx") / arity)).join(on, ["_mk_tree", "_mk_up"], "left").drop("_mk_up")
            rest = F.coalesce("_mk_rest", rest)
        at = at.withColumn("path", F.concat(own, rest)).drop("_mk_step", "_mk_rest")
        above = written(at.select("_mk_tree", "_mk_idx", "path"), f"path_{number}") if number else at
    alone = nodes.where("_mk_n = 1").withColumn("path", F.array().cast(PATH))
    leaves = alone if above is None else above.unionByName(alone)
    tops = roots[0].select("_mk_tree", "_mk_hash")
    for more in roots[1:]:
        tops = tops.unionByName(more.select("_mk_tree", "_mk_hash"))
    return tops, leaves


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf", arity: int = 2) -> DataFrame:
    """``rows`` with the root of their group (``subroot``), the ``root`` of all, and the ``path`` from
    their leaf to it: per level the digests before and after, as bytes. ``leaf`` is a hex digest."""
    if arity < 2:
        raise ValueError("runs need two nodes at least")
    key = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    plain = rows.drop(*ADDED).withColumn("_mk_key", key)
    placed = numbered(written(plain, "leaves"), "_mk_key", [*order, leaf], "_mk_idx", "_mk_n")
    placed = written(placed, "placed")
    groups = placed.select("_mk_key", F.lit(0).alias("_mk_all")).distinct()
    trees = written(numbered(groups, "_mk_all", ["_mk_key"], "_mk_tree", "_mk_trees"), "trees")
    nodes = placed.join(trees.select("_mk_key", "_mk_tree"), "_mk_key").drop("_mk_key").withColumn("_mk_hash", F.unhex(leaf))
    nodes = written(nodes, "nodes")
    subroots, leaves = _climb(nodes, arity)
    tops = trees.select("_mk_tree", "_mk_trees").join(subroots, "_mk_tree")
    tops = tops.select(F.lit(0).alias("_mk_tree"), F.col("_mk_tree").alias("_mk_idx"), F.col("_mk_trees").alias("_mk_n"), "_mk_hash")
    top, paths = _climb(written(tops, "tops"), arity)
    root = top.select(_hex(F.col("_mk_hash"))).first()
    per_tree = paths.select(F.col("_mk_idx").alias("_mk_tree"), F.col("path").alias("_mk_above"), _hex(F.col("_mk_hash")).alias("subroot"))
    joined = leaves.join(written(per_tree, "subroots"), "_mk_tree")
    whole = joined.withColumns({"path": F.concat("path", "_mk_above"), "root": F.lit(root[0] if root else None).cast("string")})
    return whole.drop(*NODE, "_mk_above")


def document_leaf(n_chars: Column | None = None) -> Column:
    """Leaf of a row of ``documents``, or what it would be with another ``n_chars``."""
    count = F.col("n_chars") if n_chars is None else n_chars
    return digest(*map(field, (F.col("doc_id"), F.col("source"), F.col("lang"), count, F.col("text"))))
