"""Aggregations of a field, through nested lists where the path has them.

All take ``stages``, a list of stage specs applied first, and return a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..dataset import Dataset, listed, quoted_path, require_fields, resolve_path
from ..plans import ranking
from .stages import viewed

DEFAULT_BINS = 50
DEFAULT_VALUES = 10_000


def count_values(ds: Dataset, field: str, stages: Sequence[dict] | None = None) -> DataFrame:
    """``value, n``: how often each value occurs. Null is a value."""
    values = resolve_path(viewed(ds, stages).df, field)
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def count_values_totals(
    ds: Dataset, field: str, stages: Sequence[dict] | None = None
) -> DataFrame:
    """One row ``total, num_values``: the sum of the counts and how many values."""
    return count_values(ds, field, stages).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("num_values"),
    )


def distinct(ds: Dataset, field: str, stages: Sequence[dict] | None = None) -> DataFrame:
    """``value``: the distinct values, ascending, without null [chosen]."""
    values = resolve_path(viewed(ds, stages).df, field)
    return values.filter(F.col("value").isNotNull()).distinct().orderBy("value")


def distinct_count(
    ds: Dataset, field: str, stages: Sequence[dict] | None = None
) -> DataFrame:
    """One row ``count``: how many distinct values there are, null not counted."""
    values = resolve_path(viewed(ds, stages).df, field)
    return values.agg(F.count_distinct("value").alias("count"))


def _without_nan(df: DataFrame) -> Column:
    value = F.col("value")
    if isinstance(df.schema["value"].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def _measure(ds, field, stages, build) -> DataFrame:
    values = resolve_path(viewed(ds, stages).df, field)
    return values.agg(*build(_without_nan(values)))


def bounds(ds: Dataset, field: str, stages: Sequence[dict] | None = None) -> DataFrame:
    """One row ``min, max``; nulls and NaN are ignored [chosen]."""
    return _measure(
        ds, field, stages, lambda v: [F.min(v).alias("min"), F.max(v).alias("max")]
    )


def mean(ds: Dataset, field: str, stages: Sequence[dict] | None = None) -> DataFrame:
    """One row ``mean``; nulls and NaN are ignored [chosen]."""
    return _measure(ds, field, stages, lambda v: [F.avg(v).alias("mean")])


def sum(ds: Dataset, field: str, stages: Sequence[dict] | None = None) -> DataFrame:
    """One row ``sum``; nulls and NaN are ignored, no value at all gives 0 [chosen]."""
    return _measure(
        ds, field, stages, lambda v: [F.coalesce(F.sum(v), F.lit(0)).alias("sum")]
    )


def std(
    ds: Dataset, field: str, stages: Sequence[dict] | None = None, sample: bool = False
) -> DataFrame:
    """One row ``std``: of the population, or with n - 1 if ``sample`` [chosen]."""
    spread = F.stddev_samp if sample else F.stddev_pop
    return _measure(ds, field, stages, lambda v: [spread(v).alias("std")])


MEASURES = ("count", "bounds", "mean", "sum", "std", "distinct_count")


def measures(ds: Dataset, wanted: Mapping[str, tuple[str, str]], stages: Sequence[dict] | None = None) -> DataFrame:
    """One row with several measures of one view, computed in one scan.

    ``wanted`` maps a column's name to ``(measure, field)``; a measure is one of
    ``MEASURES`` and means what the function of that name gives: bounds is a struct of
    ``min`` and ``max``, ``count`` is how many values there are, null ones included. Fields
    may have lists on their paths; every field is read once, however many measures it has.
    """
    if not wanted:
        raise ValueError("no measure is wanted")
    for name, (measure, _) in wanted.items():
        if measure not in MEASURES:
            raise ValueError(f"'{name}': unknown measure '{measure}', expected one of {', '.join(MEASURES)}")
    df = viewed(ds, stages).df
    fields = list(dict.fromkeys(field for _, field in wanted.values()))
    lists = [listed(df, field) for field in fields]
    kinds = [values.dtype for values in lists]
    names = [f"v{i}" for i in range(len(fields))]

    # Every value is a row with a place for each field, all but its own of which are null.
    def row(i: int, value: Column) -> Column:
        return F.struct(
            F.lit(i).alias("field"),
            *[(value if k == i else F.lit(None)).cast(kind).alias(names[k]) for k, kind in enumerate(kinds)],
        )

    parts = [F.transform(values.column, partial(row, i)) for i, values in enumerate(lists)]
    rows = df.select(F.explode(F.concat(*parts)).alias("x")).select("x.*")
    columns = []
    for name, (measure, field) in wanted.items():
        i = fields.index(field)
        value = F.col(names[i])
        if measure not in ("count", "distinct_count") and isinstance(kinds[i], (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        column = {
            "count": lambda v: F.count_if(F.col("field") == i),
            "bounds": lambda v: F.struct(F.min(v).alias("min"), F.max(v).alias("max")),
            "mean": F.avg,
            "sum": lambda v: F.coalesce(F.sum(v), F.lit(0)),
            "std": F.stddev_pop,
            "distinct_count": F.count_distinct,
        }[measure](value)
        columns.append(column.alias(name))
    return rows.agg(*columns)


def histogram_values(
    ds: Dataset,
    field: str,
    bins: int = DEFAULT_BINS,
    value_range: Sequence[float] | None = None,
    stages: Sequence[dict] | None = None,
) -> DataFrame:
    """``bin, lower, upper, n, other``: one row per bin, empty bins included.

    Bins are half-open and the last one is closed. ``other`` counts the values outside
    the range, and nulls and NaN with them; without a range the values' own bounds are
    used, and if these are equal the first bin holds everything [chosen].
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    values = resolve_path(viewed(ds, stages).df, field)
    value = _without_nan(values).cast("double")
    if value_range is None:
        ends = values.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
        lo, hi = ends["lo"], ends["hi"]
    else:
        low, high = value_range
        if not low <= high:
            raise ValueError("value_range must be [min, max]")
        lo, hi = F.lit(float(low)), F.lit(float(high))
    place = F.when(hi == lo, F.lit(0.0)).otherwise(
        F.floor((value - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins).cast("double")
    )
    bin_ = F.when(value.between(lo, hi), F.least(place, F.lit(float(bins - 1)))).cast("int")
    counts = values.groupBy(F.coalesce(bin_, F.lit(-1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most bins + 1 counts, so one small map; the bins without a row get 0.
    gathered = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts")
    )

    def count_of(b: Column) -> Column:
        return F.coalesce(F.try_element_at("counts", b), F.lit(0).cast("long"))

    width = hi - lo
    return gathered.select(
        "counts", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "bin",
        (lo + width * F.col("bin") / F.lit(float(bins))).alias("lower"),
        (lo + width * (F.col("bin") + 1) / F.lit(float(bins))).alias("upper"),
        count_of(F.col("bin")).alias("n"),
        count_of(F.lit(-1)).alias("other"),
    )


def get_values(
    ds: Dataset,
    field: str,
    stages: Sequence[dict] | None = None,
    limit: int = DEFAULT_VALUES,
) -> DataFrame:
    """``position, value, truncated``: the field's values in sample order, one per
    sample; list fields stay lists.

    ``limit=0`` means all. ``truncated`` says that the view has more samples than
    ``limit``, found out by looking one sample further.
    """
    require_fields(ds, [field])
    view = viewed(ds, stages)
    names = [f"_order_{i}" for i in range(len(view.order_columns()))]
    rows = view.df.select(
        F.col(quoted_path(field)).alias("value"),
        *[c.alias(n) for c, n in zip(view.order_columns(), names)],
    )
    keys = [F.col(n) for n in names]
    if 0 < limit <= DEFAULT_VALUES:
        seen = ranking.first_rows(rows, keys, limit + 1, view.reverse)
        # Exactly limit + 1 values or fewer, ids unique or not: an undivided window is safe.
        order = Window.orderBy(*ranking.directed(keys, view.reverse))
        place = (F.row_number().over(order) - 1).cast("long")
        more = F.count(F.lit(1)).over(Window.partitionBy()) > limit
        placed = seen.select(place.alias("position"), "value", more.alias("truncated"))
        return placed.filter(F.col("position") < limit)
    source = ranking.first_rows(rows, keys, limit + 1, view.reverse) if limit else rows
    placed = ranking.ranked(source, keys, view.reverse).select("position", "value")
    if not limit:
        return placed.withColumn("truncated", F.lit(False))
    # Read from the written ranking: the view is not computed again.
    more = placed.agg(F.coalesce(F.max("position") >= limit, F.lit(False))).scalar()
    return placed.filter(F.col("position") < limit).withColumn("truncated", more)
