"""Similarity join on word shingles with Bayesian pruning of the candidates.

Candidates (see ``similar``) have their MinHash values compared a few at a time. After
each step the posterior of the similarity, from a uniform prior, is a Beta distribution
of the agreements so far; a pair whose probability of reaching the threshold is below
``TOLERANCE`` is dropped. The texts of the nodes that are left are compared exactly.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import staged
from . import similar
from .names import fresh
from .words import SHINGLE

THRESHOLD = 0.8
TOLERANCE = 1e-9  # posterior probability below which a pair is dropped
STEP = 16  # values compared at a time


def least_agreements(threshold: float, tolerance: float, step: int = STEP, total: int = similar.PERMUTATIONS) -> list[int]:
    """For step, 2 * step, ... values: how many must agree for the posterior probability
    of ``threshold`` or more to be at least ``tolerance``.

    With m of n agreeing it is P(Beta(m + 1, n - m + 1) >= t), which equals the
    probability of at most m successes in n + 1 trials of chance t.
    """
    out = []
    for n in range(step, total + 1, step):
        below, least = 0.0, n + 1
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                least = m
                break
        out.append(least)
    return out


def surviving(a: np.ndarray, b: np.ndarray, least: list[int], step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of two signature tables that no step drops."""
    agree = np.zeros((len(a), len(b)), np.uint8)
    for k in range(step):
        agree += a[:, k][:, None] == b[:, k][None, :]
    i, j = np.nonzero(agree >= least[0])
    have = agree[i, j].astype(np.int64)
    for turn in range(1, len(least)):
        if not len(i):
            break
        part = slice(turn * step, (turn + 1) * step)
        have += (a[i, part] == b[j, part]).sum(axis=1)
        kept = have >= least[turn]
        i, j, have = i[kept], j[kept], have[kept]
    return i, j


def pruned(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """The block's nodes that still have a partner in it."""
    least = least_agreements(threshold, tolerance)

    def run(batch: pa.RecordBatch):
        side = batch.column("side").to_numpy()
        signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(len(side), -1)
        p = int((side == 0).sum())
        if p == len(side):
            i, j = surviving(signatures, signatures, least)
            i, j = i[i < j], j[i < j]
        else:
            i, j = surviving(signatures[:p], signatures[p:], least)
            j = j + p
        some = pa.array(np.unique(np.concatenate([i, j])), pa.int64())
        return batch.select(["block_1", "block_2", "side", "node"]).take(some)

    return similar.by_block(rows, run, "block_1 long, block_2 long, side int, node long")


def similar_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row for each document: ``key``, class_id, n_links.

    Two documents are linked if the sets of their runs of ``shingle`` words have a Jaccard
    similarity of ``threshold`` or more; n_links counts the others that a document is
    linked to, copies one by one. A class is what links connect, and class_id is the
    smallest key in it. A text of fewer words is one run; a text without words (null
    too) is similar to nothing and a class of its own. Repeated rows are documents of
    their own. A null key is smaller than none: a class's id is null only if all its
    keys are. Columns that are not named are ignored.
    """
    features = staged(similar.featured(docs, key, text, shingle), "signatures")
    nodes = similar.noded(features)
    homes, blocks = similar.celled(nodes)
    rows = similar.blocked(homes, blocks).join(nodes.select("node", "signature"), "node")
    left = staged(pruned(rows, threshold, tolerance), "block-survivors")
    found = similar.linked(similar.with_texts(left, docs, features, nodes, key, text, shingle), threshold, shingle)
    return similar.classed(features, nodes, found, key)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class of similar ones: that with the smallest
    key (null is the smallest), of those the one with the smallest hash of its text.

    Of rows that are equal in key and text one stays, also if they have no words; other
    documents without words all stay. All columns stay, whatever their names.
    """
    own = F.struct(F.col(f"`{key}`").alias("k"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("t"))
    rows = docs.select(own.alias("own"), F.col(f"`{text}`").alias("text"))
    classes = staged(similar_documents(rows, "own", "text", **options), "classes")
    out, more = fresh(docs.columns, "_gone"), fresh(docs.columns, "_again")
    gone = classes.filter("own != class_id").select(F.col("own").alias(out)).distinct()
    left = docs.join(gone, own == F.col(out), "left_anti")
    again = classes.groupBy("own").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("own").alias(more))
    if again.isEmpty():
        return left
    single = left.join(again, own == F.col(more), "left_anti")
    repeated = left.join(again, own == F.col(more)).dropDuplicates([more]).drop(more)
    return single.unionByName(repeated)
