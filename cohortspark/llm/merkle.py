"""Merkle trees over the rows of a dataset, with a proof for every row.

The rows of a tree are numbered in order, and the digits of a row's number (base ``run``) say where it
stands on each level. Rows are dealt out in bounded blocks of ``run ** levels`` neighbours; within a block
the digit columns are grouped away one after the other, so that each node becomes a struct which nests its
children. The nodes that blocks end in are the rows of the next layer, until one is left. On the way back
the nested structs are unfolded by ``transform`` and ``explode``: each child gets the digests that stand
beside it on its way up. Nothing is joined for that; a block and what it got from the layer above meet in a
group of two rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch

#: levels of a block: 1024 rows of a binary tree
LEVELS = 10
#: levels of a block of subroots, which are few as a rule
TOP_LEVELS = 4


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*values: Column) -> Column:
    """A row's digest: of each value ``-`` if null, else its length in UTF-8 bytes, a colon, and itself.

    Whole numbers are written in decimal.
    """
    texts = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to by the steps of its proof."""
    return F.aggregate(proof, leaf, lambda acc, step: digest(step["before"], acc, step["after"]))


def beside(proof: Column) -> Column:
    """The digests beside a leaf's way to the root, from the leaf up, as one text."""
    return F.concat_ws("", F.transform(proof, lambda step: F.concat(step["before"], step["after"])))


def _numbered(rows: DataFrame, order: list[str], run: int, work: Scratch) -> DataFrame:
    """``rank`` of each row in its ``tree`` and the tree's ``height``, by ranges that may cut a tree anywhere.

    Rows alike in ``order`` are told apart by the place where they were written.
    """
    written = work.keep(rows.withColumn("tie", F.monotonically_increasing_id()))
    keys = ["tree", *order, "tie"]
    ranges = work.keep(written.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))
    work.drop(written)
    # one row for each range and tree in it: no more than there are ranges and trees together
    sizes = ranges.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("tree")
    total = F.sum("n").over(by)
    height = reduce(Column.__add__, (F.when(total > run**j, 1).otherwise(0) for j in range(63) if run**j < 1 << 62))
    before = F.sum("n").over(by.orderBy("part")) - F.col("n")
    sizes = work.keep(sizes.select("tree", "part", before.alias("before"), height.alias("height")))
    place = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*keys[1:]))
    out = ranges.withColumn("place", place).join(sizes, ["tree", "part"])
    return out.withColumn("rank", (F.col("before") + F.col("place") - 1).cast("long")).drop("tie", "part", "place", "before")


def _blocks(nodes: DataFrame, run: int, levels: int) -> DataFrame:
    """One row for each block of ``nodes`` (tree, height, rank, node): its node, which nests all below it."""
    digits = [f"d{j}" for j in range(levels)]
    rank = F.col("rank")
    out = nodes.select(
        "tree", "height", F.expr(f"rank div {run**levels}").alias("block"),
        *(F.pmod(F.expr(f"rank div {run**j}"), F.lit(run)).cast("int").alias(d) for j, d in enumerate(digits)), "node",
    )
    # every grouping below keeps to this exchange
    out = out.repartition("tree", "block")
    for j, digit in enumerate(digits):
        keys = ["tree", "height", "block", *digits[j + 1 :]]
        out = out.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(digit).alias("digit"), "node"))).alias("kids"))
        whole = F.concat_ws("", F.transform("kids", lambda k: k["node"]["digest"]))
        # above its root a tree is one node that stays as it is
        own = F.when(F.col("height") > j, digest(whole)).otherwise(F.col("kids")[0]["node"]["digest"])
        out = out.select(*keys, F.struct(own.alias("digest"), "kids").alias("node"))
    return out


def _step(kids: Column, at: Column) -> Column:
    """The digests beside the child of number ``at`` (from 0)."""
    def text(part: Column) -> Column:
        return F.concat_ws("", F.transform(part, lambda k: k["node"]["digest"]))

    return F.struct(text(F.slice(kids, F.lit(1), at)).alias("before"), text(F.slice(kids, at + 2, F.size(kids))).alias("after"))


def _unfolded(node: Column, level: int, height: Column, none: Column) -> Column:
    """All rows below a node, each with the steps of its way up to the node."""
    if not level:
        return F.array(F.struct(node.alias("node"), none.alias("steps")))

    def child(kid: Column, at: Column) -> Column:
        step = F.when(height >= level, F.array(_step(node["kids"], at))).otherwise(none)
        return F.transform(_unfolded(kid["node"], level - 1, height, none), lambda p: F.struct(p["node"].alias("node"), F.concat(p["steps"], step).alias("steps")))

    return F.flatten(F.transform(node["kids"], child))


_STEPS = "array<struct<before:string,after:string>>"


def _proved(nodes: DataFrame, run: int, levels: int, work: Scratch, above=None) -> DataFrame:
    """``node`` (the struct given for each row), ``steps`` to the last root, and ``top`` for each of ``nodes``.

    Layer by layer, the blocks' own nodes are rolled up until each tree is one block. ``above`` gives,
    for (tree, digest) of all trees, what lies over them: tree, steps, top.
    """
    layers = []
    while True:
        blocks = work.keep(_blocks(nodes, run, levels))
        layers.append(blocks)
        if blocks.where("block > 0").isEmpty():
            break
        nodes = blocks.select("tree", (F.col("height") - levels).alias("height"), F.col("block").alias("rank"), F.struct("node.digest", "block").alias("node"))
    roots = layers[-1].select("tree", F.col("node.digest").alias("digest"))
    none = F.array().cast(_STEPS)
    over = above(roots) if above else roots.select("tree", none.alias("steps"), F.struct(F.col("digest").alias("root")).alias("top"))
    over = over.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(layers):
        # a group is one block and the one row about it from above
        both = blocks.select("tree", "block", "height", "node").unionByName(over.select("tree", "block", "steps", "top"), allowMissingColumns=True)
        both = both.groupBy("tree", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("height", "node", "steps", "top")))
        below = both.select("tree", "steps", "top", F.explode(_unfolded(F.col("node"), levels, F.col("height"), none)).alias("own"))
        out = below.select("tree", F.col("own.node").alias("node"), F.concat("own.steps", "steps").alias("steps"), "top")
        over = out.withColumn("block", F.col("node.block")) if blocks is not layers[0] else out
    return over


def manifest(docs: DataFrame, leaf: Column, tree: Column, order: Column, run: int = 2, levels: int = LEVELS) -> DataFrame:
    """``docs`` with ``merkle``: struct of leaf, subroot, root and proof.

    ``leaf`` is the digest of a row (see :func:`leaf_of`). Rows of equal ``tree`` (null is a tree of its
    own) make a tree, in ascending ``order``, nulls first: while there are several nodes, every ``run``
    neighbours become the digest of their joined digests; the last of a level may be fewer, also one.
    What is left is ``subroot``, of a single row its leaf. The subroots in order of ``tree`` (null first,
    then by UTF-8 bytes) make ``root`` in the same way. ``proof`` lists the steps from a leaf to the root:
    the digests before and after it in its run; :func:`fold` follows them. Rows equal in ``order`` stand
    in the order of their leaves; rows alike in both are interchangeable and each have a proof. No rows
    give no rows. All columns stay, but one named like the result; those of the caller are packed away
    meanwhile, so their names cannot clash, and should be few: each of them travels three times.
    """
    work = Scratch(docs.sparkSession, "merkle")
    own = [c for c in docs.columns if c.lower() != "merkle"]
    name = tree.cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("1"), name), F.lit("0")).alias("tree"),
        order.alias("at"), leaf.alias("leaf"), F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in own)).alias("own"),
    )
    rows = _numbered(rows, ["at", "leaf"], run, work)
    nodes = rows.select("tree", "height", "rank", F.struct(F.col("leaf").alias("digest"), "own").alias("node"))

    def above(roots: DataFrame) -> DataFrame:
        tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("at"), "digest")
        tops = _numbered(tops, ["at"], run, work)
        found = _proved(tops.select("tree", "height", "rank", F.struct("digest", "at").alias("node")), run, min(levels, TOP_LEVELS), work)
        return found.select(F.col("node.at").alias("tree"), "steps", F.struct(F.col("node.digest").alias("subroot"), "top.root").alias("top"))

    out = _proved(nodes, run, levels, work, above)
    merkle = F.struct(F.col("node.digest").alias("leaf"), F.col("top.subroot"), F.col("top.root"), F.col("steps").alias("proof"))
    return out.select(*(F.col("node.own")[c].alias(c) for c in own), merkle.alias("merkle"))
