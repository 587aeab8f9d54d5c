"""Data quality: issues per field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, quoted


def _checks(f: T.StructField) -> dict:
    value = F.col(quoted(f.name))
    checks = {"null": value.isNull()}
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        checks["nan"] = F.isnan(value)
    if isinstance(f.dataType, T.StringType):
        checks["empty_string"] = value == ""
    if isinstance(f.dataType, T.ArrayType):
        checks["empty_list"] = F.size(value) == 0
    return checks


def _repeats(ds: Dataset, column: str) -> DataFrame:
    """One row: how many rows repeat a value of the column that occurred already."""
    per_value = (
        ds.df.filter(F.col(quoted(column)).isNotNull())
        .groupBy(quoted(column))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return per_value.agg(
        F.lit(column).alias("field"),
        F.lit("duplicate").alias("issue"),
        F.coalesce(F.sum(F.col("times") - 1), F.lit(0)).alias("n"),
        F.coalesce(F.sum("times"), F.lit(0)).alias("of"),
    )


def find_issues(ds: Dataset) -> DataFrame:
    """``field, issue, n, share``: nulls of every field, NaNs, empty strings and empty
    lists where the type has them, and repeated ids and filepaths.

    One pass computes all field checks; the two duplicate checks group one narrow
    column each, combined before the shuffle.
    """
    fields = [f for f in ds.df.schema.fields if not f.name.startswith("_")]
    checks = [(f.name, issue, test) for f in fields for issue, test in _checks(f).items()]
    wide = ds.df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(test).alias(f"c{i}") for i, (_, _, test) in enumerate(checks)],
    )
    long = wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("field"),
                        F.lit(issue).alias("issue"),
                        F.col(f"c{i}").alias("n"),
                        F.col("rows").alias("of"),
                    )
                    for i, (name, issue, _) in enumerate(checks)
                ]
            )
        ).alias("x")
    ).select("x.*")
    for column in (ds.id_col, "filepath"):
        if column in ds.df.columns:
            long = long.unionByName(_repeats(ds, column))
    share = F.coalesce(F.col("n") / F.nullif(F.col("of"), F.lit(0)), F.lit(0.0))
    return long.select("field", "issue", "n", share.alias("share"))
