"""A Merkle manifest of a table: one tree per group, the groups' roots in one more tree.

The rows of a group are leaves in order of their key. While a tree has several
nodes, every eight neighbours (fewer in the last run, even one) become the hash
of their digests. A level is a table of (tree, place, digest); a window over one
run of at most eight rows gives each node its siblings by ``lag`` and ``lead``
at the fixed offsets 1 to 7, masked by slot and run length, and the first child
of a run hashes the parent. The way back down hands every leaf the siblings on
its path, from which the root can be folded again.

Places come from one range shuffle in total order, so no task holds a group; a
window holds eight rows. What reaches the driver are two numbers, the size of
the largest tree and how many there are. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studylake.operators.ranking import with_position
from studylake.session import materialize

FANOUT = 8

#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

ADDED = ("leaf", "subroot", "root", "path")

_NODE = ("tree", "place", "n")


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 of the fields, each ``-`` if NULL, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for field in fields:
        body = field.cast("string")
        parts.append(F.coalesce(
            F.concat(F.octet_length(body).cast("string"), F.lit(":"), body), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings on a path, level by level, left to right."""
    sides = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(sides, ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Adds ``run``, ``slot`` and the digests of the run's other nodes, ``left`` and ``right``."""
    run = F.floor(F.col("place") / FANOUT)
    placed = nodes.withColumn("run", run).withColumn("slot", F.col("place") - F.col("run") * FANOUT)
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    window = Window.partitionBy("tree", "run").orderBy("slot")
    left = [
        F.when(F.col("slot") >= k, F.lag("digest", k).over(window)).otherwise("")
        for k in range(FANOUT - 1, 0, -1)]
    right = [
        F.when(F.col("slot") + k < length, F.lead("digest", k).over(window)).otherwise("")
        for k in range(1, FANOUT)]
    return placed.withColumn("left", F.concat(*left)).withColumn("right", F.concat(*right))


def _climb(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """The levels of all trees from the leaves up; a tree ends on the level where it has one node.

    ``largest`` is the number of leaves of the largest tree.
    """
    levels, left = [leaves], largest
    while left > 1:
        parents = (
            _with_siblings(levels[-1].filter(F.col("n") > 1)).filter(F.col("slot") == 0)
            .select("tree", F.col("run").alias("place"),
                    F.ceil(F.col("n") / FANOUT).alias("n"),
                    F.sha2(F.concat("digest", "right"), 256).alias("digest")))
        levels.append(materialize(parents))
        left = -(-left // FANOUT)
    return levels


def _tops(levels: Sequence[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's last node."""
    found = [level.filter(F.col("n") == 1).select("tree", "digest") for level in levels]
    tops = found[0]
    for more in found[1:]:
        tops = tops.unionByName(more)
    return tops


def _descend(levels: Sequence[DataFrame], above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The leaves with their path: the siblings on every level, then those of ``above``.

    ``above`` has (tree, path) and the columns ``carried`` for every tree's last node. Rows of a run
    meet one row of their parent, on the run that the window was partitioned by.
    """
    known = None
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        rest = [c for c in level.columns if c not in (*_NODE, "digest")]
        own = [*_NODE[:2], "digest", *rest]
        done = level.filter(F.col("n") == 1).join(above, "tree").select(*own, "path", *carried)
        if known is not None:
            parents = known.select("tree", F.col("place").alias("run"), F.col("path").alias("up"), *carried)
            step = F.array(F.struct("left", "right"))
            done = done.unionByName(
                _with_siblings(level.filter(F.col("n") > 1)).join(parents, ["tree", "run"])
                .select(*own, F.concat(step, "up").alias("path"), *carried))
        known = materialize(done) if depth % 3 == 1 else done
    return known


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``leaf``, ``subroot``, ``root`` and ``path`` of every row of ``docs``.

    A leaf is the hash of ``fields``. The leaves of a group ascend by ``key``, then by
    their hash; groups are ordered by their bytes. NULL is a group and a key of its own,
    before all others. Repeated rows are leaves of their own with equal hashes. ``path``
    has one (left, right) per level from the leaf to the root, each the digests of the
    run's nodes before and after; a run of one node has empty ones, and a tree of one
    node no level. ``carry`` names the columns that are returned before these, ``key``
    alone by default; clashing ones are replaced. An empty table has an empty manifest.
    """
    carry = {key: F.col(key)} if carry is None else carry
    carry = {name: column for name, column in carry.items() if name not in ADDED}
    leaves = materialize(docs.select(
        F.struct(*[c.alias(name) for name, c in carry.items()]).alias("row"),
        F.col(group).alias("part"), F.col(key).alias("key"),
        leaf_hash(*[F.col(f) for f in fields]).alias("digest"),
        F.monotonically_increasing_id().alias("copy")))
    order = [F.col("part").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest"), F.col("copy")]
    placed = with_position(leaves, order, name="position")

    # a group is named by its first position, which also orders the groups
    groups = placed.groupBy("part").agg(
        F.min("position").alias("tree"), F.count(F.lit(1)).alias("n"))
    sides = groups.withColumnRenamed("part", "of")
    nodes = materialize(placed.join(sides, F.col("part").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("position") - F.col("tree")).alias("place"), "n", "digest", "row"))

    largest, trees = nodes.filter(F.col("place") == 0).agg(F.max("n"), F.count(F.lit(1))).first()
    levels = _climb(nodes.select(*_NODE, "digest"), largest or 0)
    subroots = _tops(levels)
    top = materialize(
        with_position(subroots, [F.col("tree")], name="place").select(
            F.lit(0).cast("long").alias("tree"), "place",
            F.lit(trees).cast("long").alias("n"), "digest", F.col("tree").alias("group")))
    tops = _climb(top.select(*_NODE, "digest"), trees)
    root = _tops(tops).select(
        "tree", F.col("digest").alias("root"),
        F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = materialize(
        _descend([top, *tops[1:]], root, ["root"])
        .select(F.col("group").alias("tree"), "path", "root", F.col("digest").alias("subroot")))
    found = _descend([nodes, *levels[1:]], above, ["root", "subroot"])
    return found.select(
        *[F.col("row")[name].alias(name) for name in carry],
        F.col("digest").alias("leaf"), "subroot", "root", "path")
