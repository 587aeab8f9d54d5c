"""Positions and cut-offs in a total order, without one task seeing all rows.

``orderBy().limit(n)`` keeps n rows in one task and ``orderBy().offset(n)`` moves all
rows into one partition. Both are fine for a page and wrong for a billion rows. Here a
limit or a skip becomes a filter against the key of the n-th row, so the wide rows
never move, and that key is found by selection over the bare sort keys:

* up to ``TOPK_KEYS`` keys: a top-k; on a cluster of many cores the keys of about
  ``CORES`` cores are cut to n before they meet those of the others, so no task gets n
  keys of every input task;
* beyond: quantile sketches of the first key column bound the n-th row from below and
  above, all rows below are counted exactly, and only what lies between is ranked. That is
  about a hundredth of the rows, or those that share a value (or the first bytes of a
  text) with the n-th.

``ranked`` gives all rows their positions: keys range-partitioned and sorted, written once,
and numbered as ``rows in earlier partitions + index within the partition``.

A key is a list of columns that are compared one by one, nulls lowest; as a struct it
compares the same way. It ends in the id, so a sort value shared by a third of the rows
is split over range partitions like any other.

Keys may repeat, and the number of rows is exact all the same, for every n: if rows
beyond the n-th have its key too, those with this one key are numbered where they are,
and as many of them count as are missing. Which of the equal ones these are is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .staging import staged

TOPK_ROWS = 1_000  # whole rows one top-k task may hold
TOPK_KEYS = 10_000  # bare sort keys one top-k task may hold
CORES = 16  # whose keys are cut together before all meet
GRID = 200  # quantiles asked of the sketches
ACCURACY = 1_000  # a sketch's ranks are off by one in so many at most

_INDEX_BITS = 33  # monotonically_increasing_id: partition above, row index below


def directed(keys: list[Column], reverse: bool) -> list[Column]:
    return [k.desc() if reverse else k.asc() for k in keys]


def ranked(df: DataFrame, keys: list[Column], reverse: bool = False, first: int = 0) -> DataFrame:
    """All rows of ``df`` with their global position (from ``first``) in ``position``.

    Meant for narrow rows: it takes one range shuffle and one write of all columns. The
    table is written before it is counted because range boundaries are sampled: two runs
    of the same plan may cut differently.
    """
    order = directed(keys, reverse)
    placed = _placed(df.repartitionByRange(*order).sortWithinPartitions(*order))
    return _with_offsets(placed, "ranked", first)


def _with_offsets(placed: DataFrame, label: str, first: int = 0) -> DataFrame:
    """Write rows with their partition and their index in it; number them all."""
    names = [c for c in placed.columns if c not in ("_part", "_index")]
    table = staged(placed, label)
    # One row per partition, whatever the data: a bounded window and broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return table.join(F.broadcast(offsets), "_part").select(
        *[F.col(f"`{c}`") for c in names],
        (F.col("_before") + F.col("_index") + F.lit(first)).alias("position"),
    )


def _placed(df: DataFrame) -> DataFrame:
    """Partition and index of each row where it is."""
    return df.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << _INDEX_BITS) - 1).alias("_index"),
    )


def _top(bare: DataFrame, keys: list[Column], n: int, reverse: bool) -> list:
    """The n-th row and the one after it, as far as there are any, by a top-k."""
    order = directed(keys, reverse)
    groups = bare.sparkSession.sparkContext.defaultParallelism // CORES
    if groups > 1:
        # Spark cuts each task's share of a group to n rows before the shuffle, too.
        group = F.spark_partition_id() % groups
        place = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
        bare = bare.withColumn("_group", group).withColumn("_place", place).filter(F.col("_place") <= n + 1).drop("_group", "_place")
    return bare.orderBy(*order).offset(n - 1).limit(2).collect()


def _number(key: Column, dtype: T.DataType) -> Column | None:
    """A double that never falls where the key grows, or None if the type has none."""
    if isinstance(dtype, T.StringType) and dtype.isUTF8BinaryCollation():
        value = F.conv(F.rpad(F.hex(F.substring(key.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        value = F.nanvl(key.cast("double"), F.lit(float("inf")))
    elif isinstance(dtype, T.DateType):
        value = F.unix_date(key).cast("double")
    elif isinstance(dtype, T.TimestampType):
        value = F.unix_micros(key).cast("double")
    else:
        return None
    return F.coalesce(value, F.lit(float("-inf")))


def _between(bare: DataFrame, keys: list[Column], n: int, reverse: bool) -> tuple[DataFrame, int, int]:
    """Rows among which the n-th is, its number among them, and how many they are. Two
    jobs: sketches, and exact counts around the bounds."""
    x = _number(keys[0], bare.schema[0].dataType)
    if x is None:
        return bare, n, bare.count()
    x = -x if reverse else x
    shares = [i / GRID for i in range(GRID + 1)]
    row = bare.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(x, shares, ACCURACY).alias("grid")).first()
    if row["n"] < n:
        return bare, n, row["n"]
    step = 1
    while True:
        # One step of the grid is several times what a sketch can be off.
        at = n * GRID // row["n"]
        low, high = (row["grid"][k] if 0 <= k <= GRID else None for k in (at - step, at + 1 + step))
        below = F.lit(False) if low is None else x < F.lit(low)
        above = F.lit(False) if high is None else x > F.lit(high)
        counts = bare.agg(F.count_if(below).alias("below"), F.count_if(~below & ~above).alias("inside")).first()
        if counts["below"] < n <= counts["below"] + counts["inside"]:
            return bare.filter(~below & ~above), n - counts["below"], counts["inside"]
        step *= 4


def _cut(df: DataFrame, keys: list[Column], n: int, reverse: bool) -> tuple[Column | None, int | None]:
    """The key of the n-th row (from 1) as a constant struct, or None if there are fewer
    rows; and how many rows of this key belong to the first n, or None if all do."""
    bare = df.select(*[k.alias(f"_key_{i}") for i, k in enumerate(keys)])
    own, part, m = [F.col(c) for c in bare.columns], bare, n
    if n > TOPK_KEYS:
        part, m, size = _between(bare, own, n, reverse)
        if size < m:
            return None, None
    if m <= TOPK_KEYS:
        rows = _top(part, own, m, reverse)
    else:
        rows = ranked(part, own, reverse).filter(F.col("position").isin(m - 1, m)).orderBy("position").drop("position").collect()
    if not rows:
        return None, None
    constant = df.sparkSession.createDataFrame([tuple(rows[0])], T.StructType([T.StructField(f.name, f.dataType) for f in bare.schema]))
    cut = F.struct(*[_constant(v, f.dataType, constant, f.name) for v, f in zip(rows[0], bare.schema)])
    if len(rows) == 1:
        # The last row, or the last between the bounds: then later ones have other keys.
        return cut, None
    if rows[1] != rows[0] and not any(v != v for v in rows[0]):
        return cut, None
    key = F.struct(*own)
    counts = bare.agg(F.count_if(key > cut if reverse else key < cut).alias("before"), F.count_if(key == cut).alias("tied")).first()
    here = n - counts["before"]
    return cut, None if here == counts["tied"] else here


def _constant(value, dtype: T.DataType, row: DataFrame, name: str) -> Column:
    """A value as a literal; where Python's values do not name it exactly, out of a row."""
    if value is None or isinstance(dtype, (T.StringType, T.IntegralType, T.DoubleType, T.BooleanType)):
        return F.lit(value).cast(dtype)
    return row.select(F.col(name)).scalar()


def first_rows(df: DataFrame, keys: list[Column], n: int, reverse: bool = False) -> DataFrame:
    """Exactly the first ``n`` rows, or all if there are fewer."""
    if n <= 0:
        return df.limit(0)
    if n <= TOPK_ROWS:
        return df.orderBy(*directed(keys, reverse)).limit(n)
    cut, here = _cut(df, keys, n, reverse)
    key = F.struct(*keys)
    if cut is None:
        return df
    if here is None:
        return df.filter(key >= cut if reverse else key <= cut)
    tied = _with_offsets(_placed(df.filter(key == cut)), "tied-rows").filter(F.col("position") < here)
    return df.filter(key > cut if reverse else key < cut).unionByName(tied.drop("position"))


def after_rows(df: DataFrame, keys: list[Column], n: int, reverse: bool = False) -> DataFrame:
    """All rows but exactly the first ``n``."""
    if n <= 0:
        return df
    cut, here = _cut(df, keys, n, reverse)
    if cut is None:
        return df.limit(0)
    key = F.struct(*keys)
    later = df.filter(key < cut if reverse else key > cut)
    if here is None:
        return later
    tied = _with_offsets(_placed(df.filter(key == cut)), "tied-rows").filter(F.col("position") >= here)
    return later.unionByName(tied.drop("position"))
