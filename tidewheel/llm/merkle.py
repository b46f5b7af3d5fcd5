"""Merkle manifest of a table: every row is a leaf, leaves of a group make a tree, the groups' roots make the top tree.

Leaves are numbered in their order and cut into aligned blocks.  A block keeps each of its levels as one string of
concatenated hex digests: fixed-width substrings are hashed to the level above, and the substrings that flank a node
within its run are its siblings.  The blocks' roots are the nodes of the next, shorter table, which is treated alike, so
no task sees more than one block and no driver more than the height of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import saved
from tidewheel.operators.ordering import positions

#: Nodes hashed together, and levels of a block.
FANOUT, HEIGHT = 2, 6
#: Characters of a digest.
WIDTH = 64
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that neighbours can't run together; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row's values."""
    return digest(F.concat(*map(field, values)))


def _cut(level: Column, start: Column, nodes: Column) -> Column:
    """``nodes`` digests of a level from number ``start``; what lies beyond its end is left out."""
    return F.substring(level, start * WIDTH + 1, nodes * WIDTH)


def _levels(lowest: Column, height: Column, fanout: int, most: int) -> Column:
    """A block's levels from the lowest up, each one string."""

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (WIDTH * fanout)).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda i: digest(_cut(level, i * fanout, F.lit(fanout)))), "")

    steps = F.slice(F.sequence(F.lit(1), F.lit(most)), F.lit(1), height)
    return F.aggregate(steps, F.array(lowest), lambda made, _: F.concat(made, F.array(above(F.element_at(made, -1)))))


def _siblings(levels: Column, at: Column, fanout: int) -> Column:
    """What flanks node ``at`` of the lowest level, and those above it, within their runs; the block's root has none."""
    below = F.slice(levels, F.lit(1), F.size(levels) - 1)

    def flanks(level: Column, number: Column) -> Column:
        node = F.floor(at / F.pow(F.lit(fanout), number)).cast("int")
        place = node % fanout
        return F.struct(_cut(level, node - place, place).alias("left"), _cut(level, node + 1, fanout - 1 - place).alias("right"))

    return F.transform(below, flanks)


def _climb(nodes: DataFrame, fanout: int, height: int, name: str) -> list[DataFrame]:
    """Blocks of the nodes (``tree, position, total, hash, row``), of the blocks' roots, and so on: one table per step.

    A table has ``tree, block, total, levels, members`` (``at, row``); a tree ends with the step in which it is one block.
    """
    width, steps = fanout**height, []
    while True:
        # as many levels as it takes to leave one node, if the block is the tree's last one
        lifted = F.size(F.filter(F.sequence(F.lit(0), F.lit(height - 1)), lambda n: F.pow(F.lit(fanout), n) < F.col("total")))
        blocks = nodes.groupBy("tree", F.floor(F.col("position") / width).alias("block")).agg(
            F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct((F.col("position") % width).cast("int").alias("at"), "hash", "row"))).alias("held"),
        )
        members = F.transform("held", lambda m: F.struct(m["at"].alias("at"), m["row"].alias("row")))
        lowest = F.array_join(F.transform("held", lambda m: m["hash"]), "")
        made = blocks.select("tree", "block", "total", _levels(lowest, lifted, fanout, height).alias("levels"), members.alias("members"))
        steps.append(saved(made, f"{name}-{len(steps)}"))
        nodes = steps[-1].where(F.col("total") > width).select(
            "tree", F.col("block").alias("position"), F.ceil(F.col("total") / width).alias("total"),
            F.element_at("levels", -1).alias("hash"), F.lit(0).alias("row"),
        )
        if nodes.isEmpty():
            return steps


def _roots(steps: list[DataFrame], width: int) -> DataFrame:
    """``tree, hash``: the root of each tree."""
    last = [s.where(F.col("total") <= width).select("tree", F.element_at("levels", -1).alias("hash")) for s in steps]
    out = last[0]
    for df in last[1:]:
        out = out.unionByName(df)
    return out


def _descend(steps: list[DataFrame], tops: DataFrame, fanout: int, width: int) -> DataFrame:
    """``tree, at, row``, the columns of ``tops`` and the path of each lowest node.

    ``tops`` has a row per tree with its ``path`` from there on.  What a block has above it is joined to the block, before
    its members are listed: both sides have one row per tree and block.
    """
    kept = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for step in reversed(steps):
        ending = step.where(F.col("total") <= width).select("tree").join(tops, "tree").withColumn("block", F.lit(0).cast("long"))
        above = ending if above is None else above.unionByName(ending)
        both = step.join(above, ["tree", "block"]).select("tree", "block", "levels", *kept, "path", F.explode("members").alias("m"))
        path = F.concat(_siblings(F.col("levels"), F.col("m.at"), fanout), F.col("path"))
        listed = both.select("tree", (F.col("block") * width + F.col("m.at")).alias("block"), F.col("m.row").alias("row"), *kept, path.alias("path"))
        above = listed.drop("row")
    return listed.select("tree", "row", *kept, "path")


def manifest(rows: DataFrame, group: str, order: str, hash_: str = "leaf", fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """``row`` (a struct with all columns of ``rows``), ``subroot``, ``root`` and ``path`` for every row.

    The leaf is ``hash_``; leaves of a group (null is one) ascend by ``order`` (null first), equal ones by leaf.  While
    several nodes remain, every ``fanout`` consecutive ones become the digest of their concatenation; the groups' roots,
    null first, then by the group's bytes, are treated alike.  ``path`` lists the siblings left and right of the node from
    the leaf to the root: :func:`fold` leads from a leaf to the root along it.  Repeated rows are leaves of their own; an
    empty table gives an empty one.
    """
    width = fanout**height
    # the leading digit keeps null before the empty text
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    written = saved(
        rows.select(
            tree.alias("tree"), F.col(order).alias("place"), F.col(hash_).alias("hash"), F.monotonically_increasing_id().alias("number"),
            F.struct(*[rows[c] for c in rows.columns]).alias("row"),
        ), "leaves",
    )
    placed = positions(written, ["place", "hash", "number"], ["tree"], "position", group_size=True)
    steps = _climb(placed.withColumnRenamed("position_total", "total"), fanout, height, "blocks")
    roots = saved(_roots(steps, width), "subroots")
    numbered = positions(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("place"), "hash"), ["place"], ["tree"], "position", group_size=True)
    numbered = numbered.select("tree", "position", F.col("position_total").alias("total"), "hash", F.struct(F.col("place").alias("tree"), "hash").alias("row"))
    top = _climb(numbered, fanout, height, "top")
    whole = _roots(top, width).select("tree", F.col("hash").alias("root"), F.array().cast(PATH).alias("path"))
    tops = _descend(top, whole, fanout, width).select("row.tree", F.col("row.hash").alias("subroot"), "root", "path")
    return _descend(steps, saved(tops, "tops"), fanout, width).drop("tree")


def fold(hash_: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, hash_, lambda node, level: digest(F.concat(level["left"], node, level["right"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf's level to the root's, left to right."""
    return digest(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""))
