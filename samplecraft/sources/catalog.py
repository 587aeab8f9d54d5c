"""Datasets by name: listing, loading, summaries, saved views, import and export."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, quoted, stored_definition
from ..operators.mutations import count_sample_tags
from ..operators.schema import get_field_schema
from ..operators.stages import apply_stages

# What the summary leaves out, and where its value counts end.
SUMMARY_SKIPS = ("id", "filepath", "metadata")
SUMMARY_VALUES = 100

_SKETCH_VALUES = 2 * SUMMARY_VALUES  # far above any sketch error on fewer than 100
_MAP_VALUES = 2048  # places of a field's map, which is exact up to three quarters of them

_LISTING = (
    "name string, media_type string, num_samples long, persistent boolean, "
    "tags array<string>, error string"
)

NESTED_AS_TEXT = ("csv",)  # formats without nested types


_FAILURES = (PySparkException, Py4JError)


class UnknownDataset(ValueError):
    """No dataset or view of that name."""


# -- listing and loading -------------------------------------------------------------


def load_dataset(
    spark: SparkSession, name: str, sources: Mapping[str, str] | None = None, **overrides
) -> Dataset:
    """A dataset by name: a Parquet path from ``sources``, else a catalog table or view.

    Keyword arguments set what the table itself does not record (``id_col``, ``order``).
    """
    if sources is not None and name in sources:
        df = spark.read.parquet(sources[name])
    elif spark.catalog.tableExists(name):
        df = spark.table(name)
    else:
        raise UnknownDataset(f"no dataset '{name}'")
    overrides.setdefault("name", name)
    return Dataset.from_df(df, **overrides)


def dataset_info(ds: Dataset, persistent: bool = True) -> DataFrame:
    """One row: name, media_type, num_samples, persistent, tags, info (as JSON), fields."""
    return ds.df.agg(F.count(F.lit(1)).alias("num_samples")).select(
        F.lit(ds.name).alias("name"),
        F.lit(ds.media_type).cast("string").alias("media_type"),
        "num_samples",
        F.lit(persistent).alias("persistent"),
        F.lit(list(ds.tags)).cast("array<string>").alias("tags"),
        F.lit(json.dumps(dict(ds.info), default=str)).alias("info"),
        F.lit(ds.public_columns()).alias("fields"),
    )


def list_datasets(
    spark: SparkSession, sources: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per dataset: name, media_type, num_samples, persistent, tags, error.

    ``sources`` maps names to Parquet paths; None lists the catalog. The sizes are counted
    at once, by one plan for all datasets, which reads no column. A dataset that cannot be
    opened or read has a row with its error instead of failing the listing: if the common
    plan fails, each dataset is counted on its own.
    """
    if sources is None:
        entries = [(t.name, not t.isTemporary) for t in spark.catalog.listTables()]
    else:
        entries = [(name, True) for name in sources]
    rows, counted = {}, {}
    for name, persistent in entries:
        try:
            df = spark.read.parquet(sources[name]) if sources else spark.table(name)
            known = stored_definition(df)
            rows[name] = [name, known.get("media_type"), None, persistent, list(known.get("tags", [])), None]
            counted[name] = df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        except _FAILURES as failure:
            rows[name] = [name, None, None, persistent, [], _reason(failure)]
    try:
        if counted:
            for row in reduce(DataFrame.unionByName, counted.values()).collect():
                rows[row["name"]][2] = row["n"]
    except _FAILURES:
        for name, size in counted.items():
            try:
                rows[name][2] = size.first()["n"]
            except _FAILURES as failure:
                rows[name][5] = _reason(failure)
    return spark.createDataFrame([tuple(r) for r in rows.values()], _LISTING)


def _reason(failure: Exception) -> str:
    lines = [x.strip() for x in str(failure).splitlines() if x.strip()]
    return lines[0] if lines else type(failure).__name__


# -- summary -------------------------------------------------------------------------


@dataclass(frozen=True)
class Summary:
    """The parts of a dataset summary, each a lazy DataFrame."""

    overview: DataFrame
    fields: DataFrame
    tags: DataFrame
    value_counts: DataFrame


def overview(ds: Dataset) -> DataFrame:
    """One row: name, media_type, num_samples and first_sample_id (null if empty)."""
    pick = F.max_by if ds.reverse else F.min_by
    return ds.df.agg(
        F.lit(ds.name).alias("name"),
        F.lit(ds.media_type).cast("string").alias("media_type"),
        F.count(F.lit(1)).alias("num_samples"),
        pick(F.col(quoted(ds.id_col)), ds.order_key()).alias("first_sample_id"),
    )


def _countable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.BinaryType, T.VariantType))


def summary_value_counts(ds: Dataset) -> DataFrame:
    """``field, value, n`` of every field with fewer than 100 distinct values.

    Values are text, null is a value, and lists count by element. Skipped are the id,
    the filepath and metadata, documents, and lists of floats (vectors) [chosen].

    One pass whatever the number of fields: the values are unpivoted, and every task keeps
    for each field a bounded map of values and counts and a sketch of how many there are.
    Both merge. A map that never had to let a value go is exact, and that of a field of
    which the sketch finds at most ``_SKETCH_VALUES`` never had to.
    """
    scalars, lists = [], []
    for f in ds.df.schema.fields:
        if f.name in (ds.id_col, *SUMMARY_SKIPS) or f.name.startswith("_"):
            continue
        if _countable(f.dataType):
            scalars.append(f.name)
        elif isinstance(f.dataType, T.ArrayType) and _countable(f.dataType.elementType):
            if not isinstance(f.dataType.elementType, (T.FloatType, T.DoubleType)):
                lists.append(f.name)

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"))

    def elements(name: str) -> Column:
        listed = F.transform(F.col(quoted(name)), lambda v: entry(name, v))
        return F.coalesce(listed, F.array().cast("array<struct<field:string,value:string>>"))

    if not scalars and not lists:
        return ds.spark.createDataFrame([], "field string, value string, n long")
    parts = [F.array(*[entry(n, F.col(quoted(n))) for n in scalars])] if scalars else []
    parts += [elements(n) for n in lists]
    long = ds.df.select(F.explode(F.concat(*parts)).alias("x")).select("x.*")
    # The map counts no null: a value has a mark in front, null is nothing but the mark's lack.
    marked = long.select("field", F.coalesce(F.concat(F.lit("="), "value"), F.lit("")).alias("v"))
    found = marked.groupBy("field").agg(
        F.expr(f"approx_top_k(v, {SUMMARY_VALUES}, {_MAP_VALUES})").alias("items"),
        F.approx_count_distinct("v").alias("values"),
    )
    narrow = found.filter((F.col("values") <= _SKETCH_VALUES) & (F.size("items") < SUMMARY_VALUES))
    return narrow.select("field", F.explode("items").alias("x")).select(
        "field", F.when(F.col("x.item") != "", F.substring("x.item", 2, 2**31 - 1)).alias("value"), F.col("x.count").alias("n")
    )


def dataset_summary(ds: Dataset) -> Summary:
    """Overview, fields, samples per tag, and value counts of the narrow fields."""
    fields = get_field_schema(ds).select("field", "type", "description")
    if "tags" in ds.df.columns:
        tags = count_sample_tags(ds)
    else:
        tags = ds.spark.createDataFrame([], "tag string, n long")
    return Summary(overview(ds), fields, tags, summary_value_counts(ds))


# -- saved views ---------------------------------------------------------------------


def save_view(ds: Dataset, name: str, folder: str | None = None, stages=None, replace: bool = False) -> None:
    """Save a view by name, its order and label fields with it.

    Without a ``folder`` the view lives as long as the session and stays lazy: loading it
    re-runs its stages on the current data. With one it outlives the session, in one of
    two ways: with ``stages`` their specs are saved, and ``load_view`` applies them to the
    dataset that it is given; without, the view's samples are written as they are now.
    A name that is taken raises, unless ``replace`` is set, which a written view refuses:
    lazy results may still read it.
    """
    if folder is None:
        if not replace and name in _session_views(ds.spark):
            raise ValueError(f"a view '{name}' is saved already")
        view = apply_stages(ds, stages) if stages else ds
        view.stamped().createOrReplaceTempView(name)
        return
    if replace:
        raise ValueError("a view in a folder is not replaced: save it under a new name")
    path = f"{folder.rstrip('/')}/{name}"
    if stages is None:
        export_samples(ds, path)
        return
    apply_stages(ds, stages)  # a spec that does not work is not saved
    specs = [(i, json.dumps(dict(s))) for i, s in enumerate(stages)]
    ds.spark.createDataFrame(specs, _SPECS).coalesce(1).write.parquet(path)


_SPECS = "view_stage int, view_spec string"


def _session_views(spark: SparkSession) -> set[str]:
    return {t.name for t in spark.catalog.listTables() if t.isTemporary}


def load_view(spark: SparkSession, name: str, folder: str | None = None, ds: Dataset | None = None) -> Dataset:
    """A saved view; an unknown name is an error. One that was saved as stages needs the
    dataset ``ds`` to apply them to."""
    if folder is None:
        if name not in _session_views(spark):
            raise UnknownDataset(f"no saved view '{name}'")
        return Dataset.from_df(spark.table(name))
    try:
        df = spark.read.parquet(f"{folder.rstrip('/')}/{name}")
    except PySparkException as failure:
        raise UnknownDataset(f"no saved view '{name}': {_reason(failure)}") from None
    if df.columns != ["view_stage", "view_spec"]:
        return Dataset.from_df(df)
    if ds is None:
        raise ValueError(f"the view '{name}' is saved as stages: name the dataset")
    return apply_stages(ds, [json.loads(r.view_spec) for r in df.orderBy("view_stage").collect()])


# -- import, export, clone -----------------------------------------------------------


def _flattened(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def export_samples(ds: Dataset, path: str, format: str = "parquet", **options) -> None:
    """Write a dataset; the path must be new. CSV gets nested fields as JSON text.

    Private columns are kept in Parquet, where they carry the view's order.
    """
    df = ds.stamped() if format in ("parquet", "orc") else ds.rows()
    if format in NESTED_AS_TEXT:
        df = _flattened(df)
        options = {"header": True, **options}
    df.write.format(format).options(**options).save(path)


def import_samples(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | None = None,
    id_col: str | None = None,
    order: tuple[str, ...] | None = None,
    **options,
) -> Dataset:
    """Read samples from files. Without an ``id_col`` the id is a digest of ``filepath``.

    ``binaryFile`` makes one sample per file of a directory and reads no content. CSV
    and JSON need a schema: inferring one would read the data twice, and nested fields
    in CSV come back from their JSON text.
    """
    if format == "binaryFile":
        files = spark.read.format(format).options(**options).load(path)
        listed = files.select(
            F.md5("path").alias("sample_id"),
            F.col("path").alias("filepath"),
            F.array().cast("array<string>").alias("tags"),
            F.col("modificationTime").alias("created_at"),
            F.col("length").alias("size_bytes"),
        )
        return Dataset(listed, order=("filepath",))
    if format in ("csv", "json") and schema is None:
        raise ValueError(f"{format} needs a schema")
    if format in NESTED_AS_TEXT:
        nested = (T.StructType, T.ArrayType, T.MapType)

        def stored(f: T.StructField) -> T.DataType:
            return T.StringType() if isinstance(f.dataType, nested) else f.dataType

        plain = T.StructType([T.StructField(f.name, stored(f)) for f in schema])
        options = {"header": True, **options}
        text = spark.read.format(format).options(**options).schema(plain).load(path)
        df = text.select(
            *[
                F.from_json(quoted(f.name), f.dataType).alias(f.name)
                if isinstance(f.dataType, nested)
                else quoted(f.name)
                for f in schema
            ]
        )
    else:
        reader = spark.read.format(format).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
    known = stored_definition(df)
    if id_col is None and not known and "sample_id" not in df.columns:
        df = df.withColumn("sample_id", F.md5("filepath"))
    overrides = {"id_col": id_col, "order": order}
    return Dataset.from_df(df, **{k: v for k, v in overrides.items() if v is not None})


def clone_dataset(ds: Dataset, path: str) -> Dataset:
    """Copy a dataset to a new path and open the copy."""
    export_samples(ds, path)
    return import_samples(ds.spark, path)
