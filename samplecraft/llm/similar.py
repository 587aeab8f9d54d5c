"""Candidates for similar texts, and their exact comparison, in bounded blocks.

Texts with the same set of shingles are one *node*. Nodes whose MinHash signatures agree
in all rows of a band share a bucket. Pairs are never listed: a node's *label* is the
smallest node it shares a bucket with, nodes of one label are split into cells of about
``CELL`` nodes, and two cells are compared as a block if any of their nodes share a
bucket. A group of m near copies so makes (m / CELL)^2 / 2 blocks, whose tasks report a
line for each node, not for each pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import ranked
from ..plans.staging import staged
from . import words as W

PERMUTATIONS = 128
ROWS = 4  # of a band: a pair of similarity 0.8 misses all 32 bands once in 2 * 10^7
CELL = 256  # nodes
MERGES = 2  # times that labels are taken from the nodes that share a bucket
SENT = 250_000  # nodes whose numbers may be broadcast, about 100 bytes each in memory
SLAB = 8192  # shingles compared at once


def signed(shingles: np.ndarray, bounds: np.ndarray, seed: int = 1) -> np.ndarray:
    """Signatures of 16 bits a permutation."""
    return W.signatures(shingles, bounds, *W.permutations(PERMUTATIONS, seed)).astype("<u2")


def digests(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for the set of shingles of each text."""
    out = np.zeros((len(bounds) - 1, 2), np.int64)
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        out[k] = np.frombuffer(hashlib.blake2b(np.unique(shingles[a:b]).tobytes(), digest_size=16).digest(), np.int64)
    return out


def featured(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """_key, one, two (the digest), shingles (how many), signature of every document."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, shingles, bounds in W.text_shingles(batch.column("text"), size):
                digest = digests(shingles, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(i, j - i),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([s.tobytes() for s in signed(shingles, bounds)], pa.binary()),
                    ],
                    ["_key", "one", "two", "shingles", "signature"],
                )

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"_key {kind}, one long, two long, shingles long, signature binary")


def noded(features: DataFrame) -> DataFrame:
    """One row for each distinct set of shingles: node, one, two, copies, first_key,
    signature. Copies are combined in the tasks before the shuffle."""
    some = features.filter("shingles > 0").groupBy("one", "two")
    some = some.agg(F.count(F.lit(1)).alias("copies"), F.min("_key").alias("first_key"), F.first("signature").alias("signature"))
    return ranked(some, [F.col("one"), F.col("two")]).withColumnRenamed("position", "node")


def celled(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, cell, part) of all nodes that share a bucket, and the blocks: pairs of
    cells (cell_a, part_a, cell_b, part_b), a cell with itself included."""
    bands = F.array(*[F.xxhash64(F.substring("signature", 1 + 2 * ROWS * b, 2 * ROWS)) for b in range(PERMUTATIONS // ROWS)])
    entries = nodes.select("node", F.posexplode(bands).alias("band", "value"))
    shared = entries.groupBy("band", "value").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").drop("high")
    members = staged(entries.join(shared, ["band", "value"]), "bucket-members")
    # A group's nodes have several labels at first, which meet in its buckets.
    labels = members.groupBy("node").agg(F.min("low").alias("cell"))
    for _ in range(MERGES):
        labels = staged(labels, "labels")
        lowest = members.join(labels, "node").groupBy("band", "value").agg(F.min("cell").alias("cell"))
        labels = members.join(lowest, ["band", "value"]).groupBy("node").agg(F.min("cell").alias("cell"))
    sizes = labels.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    homes = staged(labels.join(sizes, "cell").select("node", "cell", part.alias("part")), "cells")
    seen = members.select("band", "value", "node").join(homes, "node").select("band", "value", "cell", "part").distinct()
    a = seen.select("band", "value", F.col("cell").alias("cell_a"), F.col("part").alias("part_a"))
    b = seen.select("band", "value", F.col("cell").alias("cell_b"), F.col("part").alias("part_b"))
    later = F.struct("cell_a", "part_a") < F.struct("cell_b", "part_b")
    across = a.join(b, ["band", "value"]).filter(later).select("cell_a", "part_a", "cell_b", "part_b").distinct()
    within = homes.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    within = within.select(*(F.col(c).alias(f"{c}_{s}") for s in "ab" for c in ("cell", "part")))
    return homes, across.unionByName(within)


def blocked(homes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block_1, block_2, side, node): the nodes of each block; side 0 is its first cell,
    1 its second; of a cell with itself only side 0."""
    names = ["cell_a", "part_a", "cell_b", "part_b"]
    numbered = blocks.select(*names, F.xxhash64(*names).alias("block_1"), F.xxhash64(F.lit(1), *names).alias("block_2"))
    first = numbered.select("block_1", "block_2", F.lit(0).alias("side"), F.col("cell_a").alias("cell"), F.col("part_a").alias("part"))
    other = (F.col("cell_a") != F.col("cell_b")) | (F.col("part_a") != F.col("part_b"))
    second = numbered.filter(other).select("block_1", "block_2", F.lit(1).alias("side"), F.col("cell_b").alias("cell"), F.col("part_b").alias("part"))
    return first.unionByName(second).join(homes, ["cell", "part"]).drop("cell", "part")


def by_block(rows: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``run`` to the rows of each block, sides in order. A block is bounded."""

    def each(batches: Iterator[pa.RecordBatch]):
        kept: list[pa.RecordBatch] = []

        def done(table: pa.Table):
            out = run(table.combine_chunks().to_batches()[0])
            if out is not None and out.num_rows:
                yield out

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy() for c in ("block_1", "block_2")])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            if kept and tuple(ids[:, 0].tolist()) != last:
                cuts = np.concatenate([[0], cuts])
            last = tuple(ids[:, -1].tolist())
            at = 0
            for cut in cuts.tolist():
                piece = pa.Table.from_batches([*kept, batch.slice(at, cut - at)])
                kept, at = [], cut
                if piece.num_rows:
                    yield from done(piece)
            kept.append(batch.slice(at))
        if kept:
            yield from done(pa.Table.from_batches(kept))

    return rows.repartition("block_1", "block_2").sortWithinPartitions("block_1", "block_2", "side", "node").mapInArrow(each, schema)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of ``a`` has in common with each of ``b`` (all distinct)."""
    everything = np.concatenate([*a, *b]) if a or b else np.zeros(0, np.uint64)
    _, place, count = np.unique(everything, return_inverse=True, return_counts=True)
    renumbered = np.cumsum(count > 1) - 1  # only those that several texts have
    shared, place = int((count > 1).sum()), np.where(count > 1, renumbered, -1)[place]
    owner = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in [*a, *b]])
    total = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    for start in range(0, shared, SLAB):
        i, j = np.searchsorted(place, [start, start + SLAB])
        has = np.zeros((len(a) + len(b), min(SLAB, shared - start)), np.float32)
        has[owner[i:j], place[i:j] - start] = 1
        total += has[: len(a)] @ has[len(a) :].T
    return total


def joined_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n things with links i-j, the smallest thing that each is connected to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(rows: DataFrame, threshold: float, size: int) -> DataFrame:
    """Exact comparison inside each block: node, links (to documents of other nodes),
    root (the smallest node it is connected to in this block). ``rows`` has the blocks'
    node, copies and text."""

    def compare(batch: pa.RecordBatch):
        nodes, copies, side = (batch.column(c).to_numpy() for c in ("node", "copies", "side"))
        sets: list[np.ndarray] = []
        for i, j, shingles, bounds in W.text_shingles(batch.column("text"), size):
            sets += [np.unique(shingles[bounds[k] : bounds[k + 1]]) for k in range(j - i)]
        p = int((side == 0).sum())
        alone = p == len(nodes)
        left, right = (sets, sets) if alone else (sets[:p], sets[p:])
        common = overlaps(left, right).astype(np.float64)
        union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
        i, j = np.nonzero(common >= threshold * union - 1e-9)
        if alone:
            i, j = i[i < j], j[i < j]
        else:
            j = j + p
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        some = np.flatnonzero(links)
        root = joined_roots(len(nodes), i, j)
        low = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(low, root, nodes)
        return pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (nodes, links, low[root])], ["node", "links", "root"])

    return by_block(rows, compare, "node long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(node, class): the smallest node of each connected component, by large and small
    stars in turn until nothing changes, O(log^2 n) rounds for n nodes. A node's larger
    neighbours are linked to its smallest one, then it and its smaller ones are. Links
    never get more; in the end each goes to the smallest node."""
    links = edges.filter("node != root").select(F.greatest("node", "root").alias("high"), F.least("node", "root").alias("low"))
    links = staged(links.distinct(), "links")
    while True:
        # Written, so that the joins deal both sides out themselves and can split a frequent node.
        least = staged(links.groupBy("high").agg(F.min("low").alias("least")), "smallest").withColumnRenamed("high", "at")
        large = links.join(least, F.col("low") == F.col("at"), "left")
        large = large.select("high", F.coalesce("least", "low").alias("low"), F.col("least").isNotNull().alias("moved"))
        large = staged(large.groupBy("high", "low").agg(F.max("moved").alias("moved")), "links")
        least = staged(large.groupBy("high").agg(F.min("low").alias("least")), "smallest").withColumnRenamed("high", "at")
        other = F.col("low") != F.col("least")
        small = large.join(least, F.col("high") == F.col("at"))
        small = small.select(F.when(other, F.col("low")).otherwise(F.col("high")).alias("high"), F.col("least").alias("low"), (F.col("moved") | other).alias("moved"))
        small = staged(small.groupBy("high", "low").agg(F.max("moved").alias("moved")), "links")
        links = small.drop("moved")
        if small.filter("moved").isEmpty():
            roots = links.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("class"))
            return links.select(F.col("high").alias("node"), F.col("low").alias("class")).unionByName(roots)


def with_texts(rows: DataFrame, docs: DataFrame, features: DataFrame, nodes: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Adds copies and one text to rows with a node. Texts are read again; only those
    that are needed are moved, if the numbers of these are few enough to broadcast."""
    wanted = staged(rows.select("node").distinct().join(nodes.select("node", "one", "two", "copies"), "node"), "wanted-nodes")
    again = featured_texts(docs, text, size)
    few = wanted.count() <= SENT
    found = again.join(F.broadcast(wanted) if few else wanted, ["one", "two"]).groupBy("node").agg(F.first("copies").alias("copies"), F.min("text").alias("text"))
    return rows.join(found, "node")


def featured_texts(docs: DataFrame, text: str, size: int) -> DataFrame:
    """one, two (the digest), text of every document."""

    def run(batches):
        for batch in batches:
            for i, j, shingles, bounds in W.text_shingles(batch.column("text"), size):
                digest = digests(shingles, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[:, 0]), pa.array(digest[:, 1]), batch.column("text").slice(i, j - i)], ["one", "two", "text"]
                )

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "one long, two long, text string")


def classed(features: DataFrame, nodes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row for each document: ``key``, class_id (the smallest key of its class),
    n_links (documents it is similar to)."""
    found = staged(found, "block-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select("node", "root"))
    nodes = nodes.select("node", "one", "two", "copies", "first_key").join(links, "node", "left").join(classes, "node", "left")
    nodes = staged(nodes.withColumn("class", F.coalesce("class", "node")), "classed-nodes")
    firsts = nodes.groupBy("class").agg(F.min("first_key").alias("class_id"))
    nodes = nodes.join(firsts, "class").select("one", "two", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    empty = features.filter("shingles = 0").select("_key", F.col("_key").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    full = features.filter("shingles > 0").select("_key", "one", "two").join(nodes, ["one", "two"]).select("_key", "class_id", "n_links")
    return full.unionByName(empty).withColumnRenamed("_key", key)
