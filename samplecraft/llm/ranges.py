"""Ranges of a long key, cut so that each has about as many rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 20_000  # ranges; bounds what the driver and each task hold of them
LEAST_KEY = -(1 << 63)  # stands for a null key: before every other


def key_splits(rows: DataFrame, key: str, size: int, weight: str | None = None) -> np.ndarray:
    """Keys that cut ``rows`` into ranges of about ``size`` rows (or sum of ``weight``),
    at least two for each core and at most ``MOST``."""
    total = rows.agg(F.coalesce(F.sum(weight) if weight else F.count(F.lit(1)), F.lit(0))).first()[0]
    wanted = min(max(total // size, rows.sparkSession.sparkContext.defaultParallelism * 2), MOST)
    found = rows.agg(F.percentile_approx(key, [i / wanted for i in range(1, wanted)], 10 * wanted)).first()[0]
    return np.unique(np.array(found or [], np.int64))


def bucket_of(splits: np.ndarray):
    """The number of splits that are not above a key that is not null."""

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splits, keys.to_numpy(), side="right").astype(np.int32))

    return bucket
