"""Merkle manifest of a dataset: one root, and for each row the proof that it belongs to it.

A row's leaf is the digest of its fields. The leaves of each source form a
tree in id order, the roots of the sources form the tree of the dataset. A
tree is built in blocks: an aligned block of ``FANOUT ** LEVELS`` nodes keeps
each of its levels as one string of hexadecimal digests, so that a parent is
the digest of a fixed-width substring and a node's siblings are the substrings
that flank it within its run. The block's last level is one node; the last
nodes of all blocks are the nodes of the next pass, until one is left. Nodes
are numbered by a range sort over all trees, so no tree, however large, meets
in one task. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tenura.settings import materialize

#: nodes of a run, and levels that a block covers (3 ** 6 = 729 nodes)
FANOUT, LEVELS = 3, 6

#: characters of a digest
WIDTH = 64

_POSITION_BITS = 33  # monotonically_increasing_id: partition id above, row position below


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def positions(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``at``, 0, 1, 2, ... within ``tree`` by ``order``, and the ``total`` of the tree.

    One range sort by (tree, order), written with the position in the sort.
    A slice of the sort adds the rows of its trees in the slices before it.
    """
    ordered = nodes.orderBy(tree, *order).withColumn("sorted", F.monotonically_increasing_id())
    stored = materialize(ordered, "ordered").withColumn("slice", F.shiftright("sorted", _POSITION_BITS))
    parts = stored.groupBy(F.col(tree).alias("part_tree"), F.col("slice").alias("part")).agg(
        F.min("sorted").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    # at most one row per slice and tree
    of_tree = W.partitionBy("part_tree")
    before = F.sum("rows").over(of_tree.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = materialize(
        parts.select(
            "part_tree",
            "part",
            "first",
            F.coalesce(before, F.lit(0)).alias("before"),
            F.sum("rows").over(of_tree).alias("total"),
        ),
        "offsets",
    )
    same = F.col(tree).eqNullSafe(F.col("part_tree")) & (F.col("slice") == F.col("part"))
    return stored.join(offsets, same).select(
        *nodes.columns, (F.col("sorted") - F.col("first") + F.col("before")).alias("at"), "total"
    )


def _width(level: Column) -> Column:
    """Number of nodes of a level."""
    return F.floor(F.octet_length(level) / WIDTH).cast("int")


def _cut(level: Column, first: Column, last: Column) -> Column:
    """Nodes ``first`` to ``last - 1`` of a level as one string."""
    return F.substring(level, first * WIDTH + 1, (last - first) * WIDTH)


def _parents(level: Column) -> Column:
    """The next level: the digest of each run of nodes, concatenated."""
    runs = F.ceil(_width(level) / FANOUT).cast("int")
    hashes = F.transform(F.sequence(F.lit(0), runs - 1), lambda r: digest(_cut(level, r * FANOUT, (r + 1) * FANOUT)))
    return F.array_join(hashes, "").cast("binary")


def _siblings(level: Column, place: Column) -> Column:
    """The other nodes of the run that node ``place`` lies in, those before it and those after it."""
    start = F.floor(place / FANOUT).cast("int") * FANOUT
    return F.struct(
        _cut(level, start, place).cast("string").alias("before"),
        _cut(level, place + 1, F.least(start + FANOUT, _width(level))).cast("string").alias("after"),
    )


def tree_paths(nodes: DataFrame, tree: str, carried: list[str]) -> DataFrame:
    """(``tree``, ``at``, digest, *carried, path, top) of the nodes of all trees, one row per node.

    ``nodes`` holds tree, at, total, digest and the carried columns. ``path``
    lists (before, after) of each level from the node up, ``top`` is the root
    of its tree. A tree of one node is its own root and has an empty path.
    """
    size = FANOUT**LEVELS
    blocks = nodes.groupBy(tree, "total", F.floor(F.col("at") / size).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct((F.col("at") % size).cast("int").alias("place"), "digest", *carried))).alias("row")
    )
    level = F.array_join(F.transform("row", lambda r: r["digest"]), "").cast("binary")
    blocks = blocks.withColumn("level0", level)
    alone = F.col("total") <= size
    for k in range(LEVELS):
        below = F.col(f"level{k}")
        # a tree that fits a block ends with its first single node, a block of a larger tree goes up all levels
        goes_on = below.isNotNull() & (~alone | (_width(below) > 1))
        blocks = blocks.withColumn(f"level{k + 1}", F.when(goes_on, _parents(below)))
    top = F.coalesce(*[F.col(f"level{k}") for k in range(LEVELS, -1, -1)]).cast("string")
    stored = materialize(blocks.withColumn("last", top), "blocks")

    split = stored.where(~alone)
    above = split.select(tree, F.col("block").alias("at"), F.col("last").alias("digest"),
                         F.ceil(F.col("total") / size).alias("total"))
    none = F.array().cast("array<struct<before:string,after:string>>")
    whole = stored.where(alone).withColumns({"upper": none, "top": F.col("last")})
    if split.isEmpty():
        done = whole
    else:
        upper = tree_paths(above, tree, []).select(
            F.col(tree).alias("upper_tree"), F.col("at").alias("upper_at"), F.col("path").alias("upper"), "top"
        )
        same = F.col(tree).eqNullSafe(F.col("upper_tree")) & (F.col("block") == F.col("upper_at"))
        done = whole.unionByName(split.join(upper, same).drop("upper_tree", "upper_at"))
    single = done.select("*", F.explode("row").alias("node"))
    place, steps = F.col("node.place"), []
    for k in range(LEVELS):
        here = F.floor(place / FANOUT**k).cast("int")
        steps.append(F.when(F.col(f"level{k + 1}").isNotNull(), _siblings(F.col(f"level{k}"), here)))
    path = F.concat(F.array_compact(F.array(*steps)), F.col("upper"))
    return single.select(
        tree, (F.col("block") * size + place).alias("at"), *[F.col(f"node.{c}").alias(c) for c in ["digest", *carried]],
        path.alias("path"), "top",
    )


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, start, lambda node, step: digest(F.concat(step["before"], node, step["after"])))


def manifest(
    docs: DataFrame,
    fields: list[str],
    tampered: dict[str, Column] | None = None,
    id: str = "doc_id",
    tree: str = "source",
) -> DataFrame:
    """(id, tree, leaf, checked_leaf, subroot, root, path, proof, folded_root, verified) of every row.

    ``fields`` are hashed into the leaf in this order. ``tampered`` replaces
    fields by other values; the leaf of the replaced row is folded with the
    siblings of the original one, and ``verified`` tells whether that gives
    the root. ``path`` lists the siblings before and after the node of each
    level, through the source's tree and then the tree of sources; ``proof``
    is all of them in one string, left to right.

    A null field is ``-`` in the leaf, an empty text is ``0:``. Rows without a
    source are a source, which comes first; other sources are in byte order.
    Null ids come first within their source. Rows of the same id are ordered by
    their leaves, so rows that are equal throughout are leaves of their own
    with equal digests, and each row keeps a proof. An empty table gives an
    empty table. Columns of ``docs`` other than those named do not matter.
    """
    tampered = tampered or {}
    plain = docs.select(
        docs[id].alias("id"),
        docs[tree].alias("tree"),
        leaf(*[docs[c] for c in fields]).alias("digest"),
        leaf(*[tampered.get(c, docs[c]) for c in fields]).alias("checked"),
    )
    paths = tree_paths(positions(plain, "tree", ["id", "digest", "checked"]), "tree", ["id", "checked"])
    paths = materialize(paths, "paths")
    subroots = paths.where("at = 0").select(F.lit(0).alias("all"), "tree", F.col("top").alias("digest"))
    roots = materialize(tree_paths(positions(subroots, "all", ["tree"]), "all", ["tree"]), "roots").select(
        F.col("tree").alias("root_tree"), F.col("path").alias("root_path"), F.col("top").alias("root")
    )
    joined = paths.join(roots, F.col("tree").eqNullSafe(F.col("root_tree")))
    path = F.concat("path", "root_path")
    return joined.select(
        F.col("id").alias(id),
        F.col("tree").alias(tree),
        F.col("digest").alias("leaf"),
        F.col("checked").alias("checked_leaf"),
        F.col("top").alias("subroot"),
        "root",
        path.alias("path"),
        F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").alias("proof"),
        fold(F.col("checked"), path).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
