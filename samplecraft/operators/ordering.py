"""View stages that order, cut, sample and group."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dataset import ORDER, Dataset, quoted, quoted_path, require_fields
from ..plans import ranking


def _field_or_expr(ds: Dataset, field_or_expr: str | Column) -> Column:
    """A Column as it is, a field path, or else a Spark SQL expression."""
    if isinstance(field_or_expr, Column):
        return field_or_expr
    try:
        require_fields(ds, [field_or_expr])
    except ValueError:
        return F.expr(field_or_expr)
    return F.col(quoted_path(field_or_expr))


def sort_by(ds: Dataset, field_or_expr: str | Column, reverse: bool = False) -> Dataset:
    """Order by a field or expression. Nothing is sorted until the order is needed.

    Nulls come first ascending and last descending; ties are in id order, and
    ``reverse`` is the ascending order read backwards [chosen].
    """
    key = _field_or_expr(ds, field_or_expr)
    return ds.with_df(ds.df.withColumn(ORDER, key), order=(ORDER,), reverse=reverse)


def limit(ds: Dataset, limit: int) -> Dataset:
    """The first ``limit`` samples in the current order, exactly as many also if ids repeat."""
    return ds.with_df(ranking.first_rows(ds.df, ds.order_columns(), limit, ds.reverse))


def skip(ds: Dataset, skip: int) -> Dataset:
    """All samples but the first ``skip`` in the current order, exactly as many also if
    ids repeat."""
    return ds.with_df(ranking.after_rows(ds.df, ds.order_columns(), skip, ds.reverse))


def page(ds: Dataset, skip_rows: int, limit_rows: int) -> Dataset:
    """A skip followed by a limit; a small page is one top-k."""
    if 0 <= skip_rows and 0 < limit_rows and skip_rows + limit_rows <= ranking.TOPK_ROWS:
        rows = ds.df.orderBy(*ds.sort_columns()).offset(skip_rows).limit(limit_rows)
        return ds.with_df(rows)
    return limit(skip(ds, skip_rows), limit_rows)


def _random_key(ds: Dataset, seed) -> Column:
    """A hash of seed and id: as good as random, and the same when a task is retried."""
    if seed is None:
        seed = uuid.uuid4().hex
    ident = F.col(quoted(ds.id_col)).cast("string")
    return F.md5(F.concat(F.lit(f"{seed}:"), ident))


def shuffle(ds: Dataset, seed=None) -> Dataset:
    """Random order, all samples kept. A seed makes it repeatable."""
    return ds.with_df(
        ds.df.withColumn(ORDER, _random_key(ds, seed)), order=(ORDER,), reverse=False
    )


def take(ds: Dataset, take: int, seed=None) -> Dataset:
    """Exactly ``take`` random samples (all, if fewer), in the dataset's order.

    A seed makes the draw repeatable [chosen].
    """
    keys = [_random_key(ds, seed), F.col(quoted(ds.id_col))]
    return ds.with_df(ranking.first_rows(ds.df, keys, take))


def with_position(ds: Dataset, first: int = 0) -> DataFrame:
    """The samples with their place in dataset order in column ``position``.

    Only ids and sort keys are ranked and written; the samples themselves take part in
    one join by id.
    """
    return positioned(ds, first).select(*[quoted(c) for c in ds.public_columns()], "position")


def positioned(ds: Dataset, first: int = 0) -> DataFrame:
    """``ds.df``, private columns included, with the column ``position``.

    Places are joined by id, so ids that repeat raise.
    """
    names = [f"_order_{i}" for i in range(len(ds.order_columns()))]
    bare = ds.df.select(*[c.alias(n) for c, n in zip(ds.order_columns(), names)])
    places = ranking.ranked(bare, [F.col(n) for n in names], ds.reverse, first)
    places = places.select(F.col(names[-1]).alias("_id"), "position")
    if not places.groupBy("_id").count().filter("count > 1").isEmpty():
        raise ValueError(f"values of '{ds.id_col}' repeat, so samples have no place of their own")
    mine = F.col(quoted(ds.id_col)).eqNullSafe(F.col("_id"))  # a group's key may be null
    return ds.df.join(places, mine).drop("_id")


def group_by(ds: Dataset, field_or_expr: str | Column) -> Dataset:
    """One row per group: ``key``, ``n`` and ``first_id``, the group's first sample.

    Counting and picking the first are combined before the shuffle, so a group that
    holds a third of the samples costs its reducer no more than any other. The samples
    of the groups are reached with :func:`group_members` [chosen].
    """
    key = _field_or_expr(ds, field_or_expr)
    pick = F.max_by if ds.reverse else F.min_by
    groups = ds.df.groupBy(key.alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        pick(F.col(quoted(ds.id_col)), ds.order_key()).alias("first_id"),
    )
    return ds.with_df(groups, id_col="key", order=(), reverse=False, label_fields=())


def group_members(ds: Dataset, field_or_expr: str | Column) -> Dataset:
    """All samples ordered by group, and inside a group by the dataset's order."""
    key = _field_or_expr(ds, field_or_expr)
    inner = [c for c in ds.order if c != ORDER]
    df = ds.df
    if ORDER in ds.order:
        df, inner = df.withColumnRenamed(ORDER, "_inner"), ["_inner", *inner]
    return replace(ds, df=df.withColumn(ORDER, key), order=(ORDER, *inner))
