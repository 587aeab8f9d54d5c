"""A Merkle manifest of a table: one root that every row can be proved against.

A *leaf* is the digest of a row. In each source the leaves, in ascending key order, are
the bottom of a tree: runs of ``ARITY`` consecutive nodes become their digest until one is
left, the source's *subroot*. The subroots, in the order of their sources, are the bottom of
one more tree, whose top is the *root*.

Only every ``EVERY``-th level is persisted. The nodes between two persisted levels belong to
aligned subtrees of ``ARITY ** EVERY`` stored nodes at most: one group of bounded size, which
is aggregated to build the next persisted level, and again when proofs are extracted. The
missing nodes are then computed anew from the stored ones, the siblings are put out, and the
rest is dropped. Proofs go from the top down: a subtree gets the path of its top node once
and shares it out among its bottom nodes, so a path is joined to 1 / 27 of the nodes of each
level, and no join or group is keyed by the source.

A digest is sha256 as lowercase hex, of the inputs' concatenation; digests go in as hex.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranking import ranked
from ..plans.staging import new_path, staged

ARITY = 3
EVERY = 3  # levels from one persisted level to the next
BLOCK = ARITY**EVERY  # nodes of a persisted level below one node of the next

SIDES = "struct<left:string,right:string>"
_KEY, _SOURCE, _LEAF, _OTHER = "key", "source", "leaf", "other"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row: each value as ``-`` if it is null, else as its number of UTF-8
    bytes, a colon and the value as text."""
    texts = [c.cast("string") for c in columns]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path of (left, right) siblings."""
    return F.aggregate(path, leaf, lambda node, sides: digest(F.concat(sides["left"], node, sides["right"])))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, level by level and from left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def _reduced(nodes: Column) -> Column:
    """The level above consecutive nodes."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / ARITY).cast("int") - 1)
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * ARITY + 1, F.lit(ARITY)), "")))


def _subtrees(level: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Each aligned subtree of a persisted level: tree, block, size (nodes of the tree in
    this level), nodes (node and ``kept`` columns, in order), and the nodes of each level
    of it, h0 to h3. Levels above a tree's last one are as the last one."""
    entry = F.struct("index", "node", *kept)
    blocks = level.groupBy("tree", F.expr(f"index div {BLOCK}").alias("block")).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(entry)).alias("nodes"))
    blocks = blocks.withColumn("h0", F.col("nodes")["node"])
    for k in range(1, EVERY + 1):
        # Within its tree a level of one node is the last.
        last = F.col("size") <= ARITY ** (k - 1)
        blocks = blocks.withColumn(f"h{k}", F.when(last, F.col(f"h{k - 1}")).otherwise(_reduced(F.col(f"h{k - 1}"))))
    return blocks


@dataclass(frozen=True)
class Forest:
    """The persisted levels of trees: (tree, index, size, node), from the bottom up. The
    lowest one has further columns. A tree is in no level above the first that has one
    node of it."""

    levels: tuple[DataFrame, ...]

    def tops(self) -> DataFrame:
        """(tree, node): the last node of each tree."""
        found = [level.filter("size = 1").select("tree", "node") for level in self.levels]
        return reduce(DataFrame.unionByName, found)

    def paths(self, above: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
        """One row for each node of the lowest level: ``kept``, node, path, and the columns
        of ``above``, which has (tree, path) and more for each tree: the path from a
        tree's last node on. A path is a list of (left, right) siblings as text."""
        carried = [c for c in above.columns if c not in ("tree", "path")]
        parents = None  # (tree, index, path, carried) of the next persisted level
        for k in reversed(range(len(self.levels))):
            level, names = self.levels[k], list(kept) if k == 0 else []
            single = level.filter("size = 1").select("tree", "index", "node", *names).join(above, "tree")
            if parents is None:
                rows = single
            else:
                own = parents.withColumnRenamed("index", "block")
                rows = _subtrees(level.filter("size > 1"), names).join(own, ["tree", "block"])
                rows = rows.select("tree", "size", "h0", "h1", "h2", "path", *carried, F.posexplode("nodes").alias("place", "own"))
                steps = [F.when(F.col("size") > ARITY**i, F.array(_sides(F.col(f"h{i}"), F.expr(f"cast(place div {ARITY**i} as int)")))).otherwise(F.array().cast(f"array<{SIDES}>")) for i in range(EVERY)]
                rows = rows.select("tree", "own.*", F.concat(*steps, "path").alias("path"), *carried)
                rows = rows.unionByName(single)
            if k:
                rows = staged(rows.select("tree", "index", "path", *carried), "merkle-paths")
            parents = rows
        return parents.select(*kept, "node", "path", *carried)


def _sides(nodes: Column, place: Column) -> Column:
    """The siblings left and right of a node in its run."""
    first = place - F.pmod(place, F.lit(ARITY))
    left = F.array_join(F.slice(nodes, first + 1, place - first), "")
    right = F.array_join(F.slice(nodes, place + 2, first + F.lit(ARITY - 1) - place), "")
    return F.struct(left.alias("left"), right.alias("right"))


def grown(bottom: DataFrame, path: str) -> Forest:
    """Persist ``bottom`` (tree, index, size, node and more; index counts a tree's nodes
    from 0, size is their number) and every ``EVERY``-th level above it, below ``path``."""
    spark, levels, level = bottom.sparkSession, [], bottom
    while True:
        place = f"{path}/level={EVERY * len(levels)}"
        level.write.parquet(place)
        levels.append(spark.read.schema(level.schema).parquet(place))
        rest = levels[-1].filter("size > 1")
        if rest.isEmpty():
            return Forest(tuple(levels))
        size = F.ceil(F.col("size") / BLOCK).cast("long")
        level = _subtrees(rest).select("tree", F.col("block").alias("index"), size.alias("size"), F.col(f"h{EVERY}")[0].alias("node"))


@dataclass(frozen=True)
class Manifest:
    """The persisted levels of all sources' trees and of the tree of their subroots."""

    spark: SparkSession
    path: str
    sources: Forest
    top: Forest

    def root(self) -> str | None:
        """None for a table without rows."""
        row = self.top.tops().first()
        return row and row["node"]

    def subroots(self) -> DataFrame:
        """source, subroot, leaves (their number), in no particular order."""
        return self.top.levels[0].select("source", F.col("node").alias("subroot"), "leaves")

    def proofs(self) -> DataFrame:
        """One row for each row of the table: key, leaf, other, subroot, path (from the leaf
        to the root, a list of siblings left and right)."""
        none = F.array().cast(f"array<{SIDES}>")
        tops = self.top.tops().select("tree", none.alias("path"))
        above = self.top.paths(tops, ["number"]).select(F.col("number").alias("tree"), "path", F.col("node").alias("subroot"))
        found = self.sources.paths(staged(above, "merkle-tops"), [_KEY, _OTHER])
        return found.withColumnRenamed("node", _LEAF)


def build(
    rows: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    source: str = "source",
    path: str | None = None,
    other: Column | None = None,
) -> Manifest:
    """The manifest of a table, persisted below ``path`` (default: a new folder of the
    cluster's shared one).

    A leaf is the digest of ``columns``. A null source is the first one, a null key the
    first of its source, and rows of one key are ordered by their leaf, so the table's
    order and repeated rows make no difference to the root. No rows make no root.
    ``other`` is a text of the row that the proofs carry along, such as the leaf of a copy
    to be verified. Columns that are not named are ignored, whatever their names.
    """
    spark = rows.sparkSession
    path = path or new_path(spark, "merkle")
    leaf = leaf_digest([F.col(f"`{c}`") for c in columns])
    other = F.lit(None).cast("string") if other is None else other
    named = rows.select(F.col(f"`{key}`").alias(_KEY), F.col(f"`{source}`").cast("string").alias(_SOURCE), leaf.alias(_LEAF), other.alias(_OTHER))
    # Written before it is ranked: texts are then read and hashed once.
    leaves = ranked(staged(named, "merkle-leaves"), [F.col(c) for c in (_SOURCE, _KEY, _LEAF)])
    counts = leaves.groupBy(_SOURCE).agg(F.count(F.lit(1)).alias("size"), F.min("position").alias("before"))
    # The written tables' own sizes tell Spark whether they may be broadcast.
    trees = staged(ranked(counts, [F.col(_SOURCE)]).withColumnRenamed("position", "tree"), "merkle-trees")
    mine = trees.withColumnRenamed(_SOURCE, "of")
    bottom = leaves.join(mine, leaves[_SOURCE].eqNullSafe(mine["of"]))
    bottom = bottom.select("tree", (F.col("position") - F.col("before")).alias("index"), "size", F.col(_LEAF).alias("node"), _KEY, _OTHER)
    sources = grown(bottom, f"{path}/sources")
    subroots = sources.tops().withColumnRenamed("tree", "number").join(trees.withColumnRenamed("size", "leaves"), F.col("number") == F.col("tree"))
    subroots = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("number").alias("index"), F.lit(trees.count()).cast("long").alias("size"), "node", "number", _SOURCE, "leaves"
    )
    return Manifest(spark, path, sources, grown(subroots, f"{path}/top"))
