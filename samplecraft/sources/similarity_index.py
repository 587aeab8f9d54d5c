"""Stored similarity indexes: vectors in cells on storage, and what is known of each cell.

An index is built once under a key. Its vectors lie in one folder for each cell around a
pivot (``vector_cells``), its bounds in a small table. A search compares the query with
the pivots, finds from the bounds alone which cells can hold one of the nearest, and reads
only their folders; nothing is approximated.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dataset import Dataset
from ..functions import vectors as V
from ..plans import vector_cells
from ..plans.vector_cells import DIGEST

INDEX_ROWS = 16_384  # distinct vectors of a cell, about, which is a folder
FILE_ROWS = 65_536  # rows of one of a cell's files, about
WIDEN = 4  # a search of a view that found too few takes this many times the vectors


@dataclass(frozen=True)
class SimilarityIndex:
    """An opened index: its pivots and bounds, one row for each cell that is not empty."""

    spark: SparkSession
    path: str
    id_col: str
    field: str
    metric: str
    cells: np.ndarray
    pivots: np.ndarray
    rows: np.ndarray
    inner: np.ndarray
    outer: np.ndarray

    @property
    def members(self) -> DataFrame:
        """``id, vec, cell`` of all vectors."""
        return self.spark.read.parquet(f"{self.path}/members")

    def bounds(self, vector: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest distance that a vector of each cell can have from
        ``vector``, in the distance of the cells (Euclidean, of unit vectors if cosine)."""
        unit = self.metric == "cosine"
        target = np.asarray(vector, dtype=float)[None, :]
        if target.shape[1] != self.pivots.shape[1]:
            raise ValueError(f"the query has {target.shape[1]} dimensions, the index {self.pivots.shape[1]}")
        length = float(np.linalg.norm(target))
        if unit:
            if not length > 0.0:
                raise ValueError("a query vector of length zero has no direction")
            target = target / length
        apart = vector_cells.distances(target, self.pivots, unit)[0]
        home = int(apart.argmin())
        gap = vector_cells.distances(self.pivots[home : home + 1], self.pivots, unit)[0]
        longest = np.linalg.norm(self.pivots, axis=1).max(initial=1.0)
        slack = vector_cells._SLACK * (max(longest, 1.0 if unit else length) + self.outer.max(initial=0.0))
        # A member is nearer to its own pivot than to the query's.
        plane = np.divide(apart**2 - apart[home] ** 2, 2.0 * gap, out=np.zeros_like(apart), where=gap > slack)
        low = np.maximum.reduce([plane, self.inner - apart, apart - self.outer])
        return low - slack, apart + self.outer + slack

    def _read(self, chosen: np.ndarray, vector: Sequence[float], within: DataFrame | None) -> DataFrame:
        rows = self.members.filter(F.col("cell").isin([int(c) for c in self.cells[chosen]]))
        if within is not None:
            rows = rows.join(within.select(F.col(within.columns[0]).alias("id")), "id", "left_semi")
        return rows.select("id", V.distance_to(F.col("vec"), list(vector), self.metric).alias("distance"))

    def nearest(self, vector: Sequence[float], k: int, within: DataFrame | None = None) -> DataFrame:
        """``id, distance``: the ``k`` nearest vectors, nearest first, ties by id.

        ``within`` is a DataFrame of ids: only these count. Without it the cells to read
        follow from the bounds and counts, and no job runs before the result's own. With
        it the nearest cells are read first, more if they hold too few of the ids, and the
        distance of the k-th found says which other cells there can be any nearer in.
        """
        if k < 1:
            raise ValueError("k must be at least 1")
        low, high = self.bounds(vector)
        if within is None:
            order = np.argsort(high, kind="stable")
            enough = int(np.searchsorted(np.cumsum(self.rows[order]), k))
            bound = high[order[enough]] if enough < len(order) else math.inf
        else:
            order, need = np.argsort(low, kind="stable"), k
            total = np.cumsum(self.rows[order])
            while True:
                enough = int(np.searchsorted(total, need)) + 1
                if enough >= len(order):
                    bound = math.inf
                    break
                found = self._read(order[:enough], vector, within).orderBy("distance").limit(k)
                count, far = found.agg(F.count(F.lit(1)), F.max("distance")).first()
                if count == k:
                    # In the distance of the cells, and never too small.
                    bound = math.sqrt(max(2.0 * far, 0.0)) if self.metric == "cosine" else far
                    break
                need *= WIDEN
        return self._read(np.flatnonzero(low <= bound), vector, within).orderBy("distance", "id").limit(k)


def _place(folder: str, brain_key: str) -> str:
    if not brain_key or "/" in brain_key:
        raise ValueError(f"'{brain_key}' is no key for an index")
    return f"{folder.rstrip('/')}/{brain_key}"


def build_similarity_index(
    ds: Dataset, brain_key: str, folder: str, field: str | None = None, metric: str = "cosine", cell_rows: int = INDEX_ROWS
) -> SimilarityIndex:
    """Write an index of ``field`` (default: the only vector field) under ``brain_key``;
    an index of that key is replaced.

    Left out are samples whose vector is null, has a missing number or, for the cosine
    metric, has length zero. Copies of one vector are one in the cells' sizes, so they make
    a cell's files many but not its neighbours' pivots. The table that makes the index one
    is written last: a build that dies leaves nothing that opens.
    """
    from ..operators.similarity import embedding_field

    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {', '.join(V.METRICS)}")
    name, path, unit = embedding_field(ds, field), _place(folder, brain_key), metric == "cosine"
    spark = ds.spark
    about = spark.createDataFrame([(ds.id_col, name, metric)], "id_col string, field string, metric string")
    about.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    rows = vector_cells.comparable(ds.df, ds.id_col, name, unit)
    cells = vector_cells.build_cells(vector_cells.collapse(rows), unit, cell_rows)
    if cells is None:
        raise ValueError(f"'{name}' has no vector that can be compared")
    size = cells.members.groupBy("cell").agg(F.sum("copies").alias("n")).collect()  # a row for each pivot
    count = np.zeros(len(cells.rows), np.int64)
    for cell, n in size:
        count[cell] = n
    # One row per distinct vector on the right side, so a hot vector can be split.
    placed = rows.join(cells.members.select(*DIGEST, "cell"), DIGEST).select("id", "vec", "cell")
    files = F.element_at(F.lit([int(n) for n in -(-np.maximum(count, 1) // FILE_ROWS)]), F.col("cell") + 1)
    part = F.pmod(F.xxhash64("id"), files)
    placed.repartition("cell", part).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/members")
    filled = np.flatnonzero(count)
    facts = [
        (int(c), [float(x) for x in cells.pivots[c]], int(count[c]), float(cells.inner[c]), float(cells.outer[c])) for c in filled
    ]
    schema = "cell int, pivot array<double>, n long, inner double, outer double"
    spark.createDataFrame(facts, schema).write.mode("overwrite").parquet(f"{path}/cells")
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return open_similarity_index(spark, brain_key, folder)


def open_similarity_index(spark: SparkSession, brain_key: str, folder: str) -> SimilarityIndex:
    """The index that was built under a key; raises if there is none."""
    path = _place(folder, brain_key)
    try:
        about = spark.read.parquet(f"{path}/about").first()
    except AnalysisException as failure:
        raise ValueError(f"no similarity index '{brain_key}' in {folder}") from failure
    if about is None:
        raise ValueError(f"similarity index '{brain_key}' was not built to its end")
    facts = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()  # at most MAX_PIVOTS rows
    return SimilarityIndex(
        spark, path, about["id_col"], about["field"], about["metric"],
        facts["cell"].to_numpy(), vector_cells.matrix(facts["pivot"], False),
        *(facts[c].to_numpy() for c in ("n", "inner", "outer")),
    )
