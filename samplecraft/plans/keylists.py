"""Lists of ids or values given by the caller, turned into predicates or joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

INLINE_VALUES = 1_000  # longer lists become a table, so the plan stays small


def first_occurrences(values: Iterable) -> list:
    return list(dict.fromkeys(values))


def typed_keys(values: Iterable, dtype: T.DataType) -> list:
    """The distinct values that are not None, as values of a field's type, in order.

    A text field takes every value as its text. For other types a value that the type
    does not hold raises, whether the list is short or long.
    """
    known = [v for v in values if v is not None]
    if isinstance(dtype, T.StringType):
        return first_occurrences(str(v) for v in known)
    try:
        found = pa.array(known, type=to_arrow_type(dtype)).to_pylist()
        if isinstance(dtype, T.IntegralType) and found != known:
            raise TypeError(f"no whole numbers: {[v for v, f in zip(known, found) if v != f][:3]}")
        return first_occurrences(found)
    except (pa.ArrowException, TypeError, OverflowError) as failure:
        raise ValueError(f"not all values are of the type {dtype.simpleString()}: {failure}") from None


def typed_mapping(mapping: Mapping, dtype: T.DataType, value_type: T.DataType | None = None) -> dict:
    """A mapping with its keys, and its values if their type is given, as values of a
    field's type. None stays None, as a key too; of keys that become equal the last wins."""

    def one(value, kind):
        return value if value is None or kind is None else typed_keys([value], kind)[0]

    return {one(k, dtype): one(v, value_type) for k, v in mapping.items()}


def key_table(
    spark: SparkSession, columns: dict[str, tuple[list, T.DataType]]
) -> DataFrame:
    """A table of driver-side lists. Arrow input gives Spark its exact size, so it
    broadcasts it only when it is under the session's broadcast threshold."""
    arrays = {
        name: pa.array(values, type=to_arrow_type(dtype))
        for name, (values, dtype) in columns.items()
    }
    schema = T.StructType([T.StructField(n, d) for n, (_, d) in columns.items()])
    if not next(iter(columns.values()))[0]:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pa.table(arrays), schema)


def keys_with_position(
    spark: SparkSession, keys, dtype: T.DataType, need_position: bool
) -> DataFrame:
    """Distinct keys as ``_key``, and if needed their first place as ``_position``.

    A DataFrame brings the keys in its first column and, for an ordered selection, a
    ``position`` column: rows of a DataFrame have no order of their own.
    """
    if isinstance(keys, DataFrame):
        key = F.col(f"`{keys.columns[0]}`").cast(dtype).alias("_key")
        if not need_position:
            return keys.select(key).distinct()
        if "position" not in keys.columns:
            raise ValueError("an ordered selection by DataFrame needs a 'position' column")
        return keys.groupBy(key).agg(F.min("position").cast("long").alias("_position"))
    unique = first_occurrences(keys)
    return key_table(
        spark,
        {"_key": (unique, dtype), "_position": (list(range(len(unique))), T.LongType())},
    )
