"""Distances from a vector column to one vector, in double precision."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "euclidean")


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def usable(v: Column, unit: bool) -> Column:
    """Whether a vector can be compared: not null, only finite numbers, a finite length,
    and if ``unit`` one above zero. One pass over each Arrow batch."""

    @F.arrow_udf("boolean")
    def run(vectors: pa.Array) -> pa.Array:
        squares = vectors.flatten().to_numpy(zero_copy_only=False).astype(float) ** 2
        total = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(squares), squares, 0.0))])
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(squares))])
        positive = np.concatenate([[0], np.cumsum(squares > 0)])
        ends = np.cumsum(vectors.value_lengths().fill_null(0).to_numpy())
        starts = np.concatenate([[0], ends[:-1]])
        good = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[starts])
        good &= np.isfinite(total[ends] - total[starts])
        if unit:
            good &= positive[ends] > positive[starts]
        return pa.array(good)

    return run(as_doubles(v))


def distance_to(v: Column, target: list[float], metric: str) -> Column:
    """The distance of each vector to ``target``, one Arrow batch at a time.

    Null for a null vector, NaN where a number is missing, and for the cosine metric also
    for a vector of length zero. A vector of another length than the target raises.
    """
    to = np.asarray(target, dtype=float)
    length = math.sqrt(math.fsum(x * x for x in target))
    if metric == "cosine" and not length > 0.0:
        raise ValueError("a query vector of length zero has no direction")

    @F.arrow_udf("double")
    def apart(vectors: pa.Array) -> pa.Array:
        known = vectors.is_valid().to_numpy(zero_copy_only=False)
        sizes = vectors.value_lengths().fill_null(len(to)).to_numpy()
        if (sizes != len(to)).any():
            other = int(sizes[sizes != len(to)][0])
            raise ValueError(f"a vector has {other} dimensions, the query {len(to)}")
        rows = vectors.drop_null().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(to))
        with np.errstate(divide="ignore", invalid="ignore"):
            if metric == "cosine":
                found = 1.0 - (rows @ (to / length)) / np.sqrt((rows * rows).sum(axis=1))
            else:
                found = np.sqrt(((rows - to) ** 2).sum(axis=1))
        out = np.full(len(vectors), np.nan)
        out[known] = found
        return pa.array(out, mask=~known)

    # Not deterministic for the planner: a filter on it must not compute it twice.
    return apart.asNondeterministic()(as_doubles(v))
