"""Greedy matching of predicted and true boxes, for all samples of an Arrow batch at once.

Labels are flat arrays with offsets, and no Python object is made for one. A *group* is what
can match: the labels of one class of one sample. Predictions take turns inside their group
only, so the first ones of all groups are matched in one step, then all second ones, and so
on: as many steps as the largest group has predictions, each over the truths of the groups
that are left.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIR = "struct<pred_id:string,truth_id:string,iou:double>"
_RESULT = f"struct<pairs:array<{PAIR}>,pred_hit:array<boolean>,truth_hit:array<boolean>>"


class Labels:
    """The labels of some lists, flat: row, id, label, confidence and corners."""

    def __init__(self, lists: pa.ListArray):
        size = pc.list_value_length(lists).fill_null(0).to_numpy()
        self.bounds = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        self.row = np.repeat(np.arange(len(lists)), size)
        flat = lists.flatten()  # in order, without what null rows have
        self.id, self.label, self.confidence, boxes = flat.flatten()
        self.box = _corners(boxes)
        self.turn = np.empty(len(flat), np.int64)  # of the id, nulls first
        self.turn[pc.array_sort_indices(self.id, null_placement="at_start").to_numpy()] = np.arange(len(flat))

    def by_confidence(self) -> np.ndarray:
        """Order of predictions: confidence descending, NaN and then null last, then id."""
        value = self.confidence.fill_null(np.nan).to_numpy(zero_copy_only=False)
        known = self.confidence.is_null().to_numpy(zero_copy_only=False)
        return np.lexsort([self.turn, np.where(np.isnan(value), 0.0, -value), np.isnan(value), known])


def _corners(boxes: pa.ListArray) -> np.ndarray:
    """x, y, width and height of each box; a missing number makes no overlap."""
    size = pc.list_value_length(boxes).fill_null(0).to_numpy()
    begin = np.cumsum(size) - size
    values = boxes.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    out = np.full((len(boxes), 4), np.nan)
    for k in range(4):
        some = size > k
        out[some, k] = values[begin[some] + k]
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of boxes row by row; 0 for two empty boxes or a missing one."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ends = np.minimum(a[:, :2] + a[:, 2:], b[:, :2] + b[:, 2:])
        inter = np.maximum(ends - np.maximum(a[:, :2], b[:, :2]), 0.0).prod(axis=1)
        union = a[:, 2] * a[:, 3] + b[:, 2] * b[:, 3] - inter
        return np.where((union != 0) & ~np.isnan(inter / union), inter / union, 0.0)


def matched(preds: Labels, truths: Labels, least: float, classwise: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prediction, truth, IoU) by flat position, in the order of rows and turns. Each
    prediction, by descending confidence and then id, takes the free truth of its class with
    the highest IoU, ties by id."""
    n, m = len(preds.row), len(truths.row)
    kind = np.zeros(n + m, np.int64)
    if classwise and n + m:
        names = pa.concat_arrays([preds.label.cast(pa.string()), truths.label.cast(pa.string())])
        kind = names.dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64) + 1
    groups, group = np.unique(np.concatenate([preds.row, truths.row]) * (kind.max(initial=0) + 1) + kind, return_inverse=True)
    own, their = group[:n], group[n:]
    order = np.lexsort([truths.turn, their])  # truths by group, in the order of their ids
    count = np.bincount(their, minlength=len(groups))
    start = np.cumsum(count) - count
    box, free = truths.box[order], np.ones(m, bool)

    turns = preds.by_confidence()
    turns = turns[count[own[turns]] > 0]
    by_group = turns[np.argsort(own[turns], kind="stable")]
    ahead = np.bincount(own[by_group], minlength=len(groups))
    place = np.arange(len(by_group)) - (np.cumsum(ahead) - ahead)[own[by_group]]
    step = np.argsort(place, kind="stable")
    ends = np.cumsum(np.bincount(place)) if len(place) else []
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    begin = 0
    for end in ends:
        mine = by_group[step[begin:end]]  # at most one prediction of each group
        begin = end
        size = count[own[mine]]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(start[own[mine]] - first, size)
        rated = np.where(free[at], overlap(np.repeat(preds.box[mine], size, axis=0), box[at]), -1.0)
        best = np.maximum.reduceat(rated, first)
        top = np.flatnonzero(rated == np.repeat(best, size))
        top = top[np.searchsorted(top, first)]  # the first one of each
        good = (best >= least) & free[at[top]]
        free[at[top[good]]] = False
        found.append((mine[good], order[at[top[good]]], best[good]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    p, t, iou = (np.concatenate(parts) for parts in zip(*found))
    rank = np.empty(n, np.int64)
    rank[preds.by_confidence()] = np.arange(n)
    final = np.lexsort([rank[p], preds.row[p]])
    return p[final], t[final], iou[final]


def matches(preds: Column, truths: Column, least: float, classwise: bool) -> Column:
    """For each row's lists of (id, label, confidence, box): the matched pairs, and which
    labels of either list are in one. Null for rows where a list is null or empty: these
    have nothing to match and are not sent to Python."""

    @F.arrow_udf(_RESULT)
    def run(p: pa.Array, t: pa.Array) -> pa.Array:
        mine, theirs = Labels(p), Labels(t)
        i, j, iou = matched(mine, theirs, least, classwise)
        hit, taken = np.zeros(len(mine.row), bool), np.zeros(len(theirs.row), bool)
        hit[i], taken[j] = True, True
        until = np.searchsorted(mine.row[i], np.arange(len(p) + 1))
        pairs = pa.StructArray.from_arrays([mine.id.take(pa.array(i)), theirs.id.take(pa.array(j)), pa.array(iou, pa.float64())], ["pred_id", "truth_id", "iou"])

        def listed(bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)

        lists = [listed(until, pairs), listed(mine.bounds, pa.array(hit)), listed(theirs.bounds, pa.array(taken))]
        nothing = pc.or_(p.is_null(), t.is_null())
        return pa.StructArray.from_arrays(lists, ["pairs", "pred_hit", "truth_hit"], mask=nothing)

    both = (F.size(preds) > 0) & (F.size(truths) > 0)

    def plain(labels: Column) -> Column:
        return F.when(
            both,
            F.transform(
                labels,
                lambda x: F.struct(
                    x["id"].cast("string").alias("id"),
                    x["label"].cast("string").alias("label"),
                    x["confidence"].cast("double").alias("confidence"),
                    x["box"].cast("array<double>").alias("box"),
                ),
            ),
        )

    # Not deterministic for the planner: it must not match twice to filter on the result.
    return run.asNondeterministic()(plain(preds), plain(truths))
