"""Mutations: new dataset versions, with a count of the samples they touched.

A mutation returns a :class:`Change`. Nothing is written until :meth:`Change.write`,
which counts in the same job as it writes; a path that is being read is never
overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, field_type, quoted, quoted_path, resolve_path, with_path
from ..functions.predicates import text_array
from ..plans.keylists import INLINE_VALUES, first_occurrences, key_table, typed_mapping
from .ordering import positioned
from .samples import id_flag
from .stages import apply_stages

_TOUCHED = "_touched"


@dataclass(frozen=True)
class Change:
    """A dataset version and which of its samples the change touched."""

    flagged: Dataset

    @property
    def dataset(self) -> Dataset:
        return self.flagged.with_df(self.flagged.df.drop(_TOUCHED))

    def count(self) -> DataFrame:
        """One row ``n``: the samples touched."""
        return self.flagged.df.agg(F.count_if(_TOUCHED).alias("n"))

    def ids(self) -> DataFrame:
        """The ids of the samples touched, in column ``sample_id``."""
        touched = self.flagged.df.filter(_TOUCHED)
        return touched.select(F.col(quoted(self.flagged.id_col)).alias("sample_id"))

    def write(self, path: str, format: str = "parquet") -> int:
        """Write the new version and return the count, in one job."""
        seen = Observation()
        stamped = self.flagged.stamped().observe(seen, F.count_if(_TOUCHED).alias("n"))
        stamped.drop(_TOUCHED).write.format(format).save(path)
        return seen.get["n"]


# -- tags ---------------------------------------------------------------------------


def _selection(ds: Dataset, view, sample_ids) -> DataFrame:
    if view is not None and not isinstance(view, Dataset):
        view = apply_stages(ds, view) if view else None
    return id_flag(ds, view, sample_ids, _TOUCHED)


def _with_tags(df: DataFrame) -> DataFrame:
    """A dataset that has never been tagged gets the field."""
    return df if "tags" in df.columns else df.withColumn("tags", F.lit(None).cast("array<string>"))


def _tag_list(tags: str | Sequence[str]) -> list[str]:
    return first_occurrences([tags] if isinstance(tags, str) else tags)


def tag_samples(
    ds: Dataset, tags: str | Sequence[str], view=None, sample_ids=None
) -> Change:
    """Add tags to the selected samples; tags behave as a set [chosen].

    ``sample_ids`` wins over ``view`` (a dataset or stage specs), an empty list selects
    nobody, and neither selects everybody. Samples that had the tags already count.
    """
    df = _with_tags(_selection(ds, view, sample_ids))
    old = F.coalesce("tags", F.array().cast("array<string>"))
    added = F.array_union(old, text_array(_tag_list(tags)))
    df = df.withColumn("tags", F.when(F.col(_TOUCHED), added).otherwise(F.col("tags")))
    return Change(ds.with_df(df))


def untag_samples(
    ds: Dataset, tags: str | Sequence[str], view=None, sample_ids=None
) -> Change:
    """Remove tags from the selected samples; selection and count as in
    :func:`tag_samples`. Other tags keep their places and repeats."""
    df = _with_tags(_selection(ds, view, sample_ids))
    gone = _tag_list(tags)
    left = F.filter("tags", lambda t: ~F.coalesce(t.isin(gone), F.lit(False)))
    df = df.withColumn("tags", F.when(F.col(_TOUCHED), left).otherwise(F.col("tags")))
    return Change(ds.with_df(df))


def count_sample_tags(ds: Dataset) -> DataFrame:
    """``tag, n``: the number of samples with each tag."""
    once = _with_tags(ds.df).select(F.array_distinct("tags").alias("tags"))
    return (
        resolve_path(once, "tags")
        .filter(F.col("value").isNotNull())
        .groupBy(F.col("value").alias("tag"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# -- values -------------------------------------------------------------------------


def _spark_type(spark: SparkSession, values: Sequence) -> T.DataType:
    """The type of a list of Python values, by Spark's own inference."""
    known = [(value,) for value in values if value is not None]
    return spark.createDataFrame(known, ["v"]).schema["v"].dataType if known else T.StringType()


def _unique_values(values: DataFrame) -> DataFrame:
    """``(_key, _value)``, failing when a key occurs twice: which value would win?"""
    key, value = (F.col(quoted(c)) for c in values.columns[:2])
    once = values.groupBy(key.alias("_key")).agg(
        F.any_value(value).alias("_value"), F.count(F.lit(1)).alias("_times")
    )
    twice = F.concat(F.lit("more than one value for key "), F.col("_key").cast("string"))
    return once.select(
        "_key",
        F.when(F.col("_times") == 1, F.col("_value"))
        .otherwise(F.raise_error(twice).cast(values.schema[1].dataType))
        .alias("_value"),
    )


def keyed_values(ds: Dataset, values: Mapping | DataFrame, key_name: str) -> DataFrame:
    """``(_key, _value, _hit)`` of the values given for keys; a key occurs once."""
    key_type = field_type(ds.df.schema, key_name)
    if isinstance(values, Mapping):
        values = {k: v for k, v in typed_mapping(values, key_type).items() if k is not None}
        keys, given = list(values), list(values.values())
        table = key_table(
            ds.spark, {"_key": (keys, key_type), "_value": (given, _spark_type(ds.spark, given))}
        )
    else:
        table = _unique_values(values)
    return table.select(F.col("_key").cast(key_type), "_value", F.lit(True).alias("_hit"))


def set_values(
    ds: Dataset,
    field: str,
    values: Mapping | Sequence | DataFrame,
    key_field: str | None = None,
    keep_unmatched: bool = False,
) -> Change:
    """Set a field, new or not, of all samples.

    * a dict ``{id: value}`` or a DataFrame ``(key, value)``: of a dict's keys that are
      equal as values of the key field the last wins, and None is no key; samples without
      a value get null, unless ``keep_unmatched`` keeps what they have [chosen]. The count is
      of the non-null values assigned. ``key_field`` replaces the id as the key.
    * a list: one value per sample in dataset order, and the count is of all samples.
    """
    fields = ds.df.schema.fieldNames()
    exists = field.split(".")[0] in fields
    if isinstance(values, (Mapping, DataFrame)):
        key_name = key_field or ds.id_col
        table = keyed_values(ds, values, key_name)
        df = ds.df.join(table, F.col(quoted_path(key_name)) == F.col("_key"), "left")
        new: Column = F.col("_value")
        touched = F.col("_value").isNotNull()
    else:
        given = list(values)
        places = key_table(
            ds.spark,
            {
                "position": (list(range(len(given))), T.LongType()),
                "_value": (given, _spark_type(ds.spark, given)),
            },
        ).withColumn("_hit", F.lit(True))
        have = ds.df.count()
        if have != len(given):
            raise ValueError(f"{len(given)} values for {have} samples")
        df = positioned(ds).join(places, "position").drop("position")
        new, touched = F.col("_value"), F.lit(True)
    if exists:
        old = F.col(quoted_path(field))
        new = new.cast(field_type(ds.df.schema, field))
        if keep_unmatched:
            new = F.when(F.col("_hit"), new).otherwise(old)
    df = with_path(df.withColumn(_TOUCHED, touched), field, new)
    return Change(ds.with_df(df.drop("_key", "_value", "_hit")))


def remap_values(ds: Dataset, field: str, mapping: Mapping | DataFrame) -> Dataset:
    """Replace values of a scalar field; values not in the mapping stay.

    A long mapping, or a DataFrame ``(old, new)``, is joined instead of inlined. Keys
    and values must be of the field's type. None as a key stands for null, None as a
    value makes null.
    """
    dtype = field_type(ds.df.schema, field)
    value = F.col(quoted_path(field))
    if isinstance(mapping, Mapping):
        pairs = typed_mapping(mapping, dtype, dtype)
        of_null = F.lit(pairs.pop(None, None)).cast(dtype)
        if not pairs:
            new = F.coalesce(value, of_null)
            return ds.with_df(with_path(ds.df, field, new))
        if len(pairs) <= INLINE_VALUES:
            table = F.create_map(*[F.lit(x).cast(dtype) for pair in pairs.items() for x in pair])
            new = F.when(F.map_contains_key(table, value), F.try_element_at(table, value)).otherwise(value)
            return ds.with_df(with_path(ds.df, field, F.when(value.isNull(), of_null).otherwise(new)))
        table = key_table(ds.spark, {"_key": (list(pairs), dtype), "_value": (list(pairs.values()), dtype)})
    else:
        table = _unique_values(mapping)
        of_null = table.filter("_key IS NULL").select(F.col("_value").cast(dtype)).scalar()
        table = table.filter("_key IS NOT NULL")
    keys = table.select(F.col("_key").cast(dtype), F.col("_value").cast(dtype), F.lit(True).alias("_hit"))
    df = ds.df.join(keys, value == F.col("_key"), "left")
    new = F.when(value.isNull(), of_null).when(F.col("_hit"), F.col("_value")).otherwise(value)
    return ds.with_df(with_path(df, field, new).drop("_key", "_value", "_hit"))


def clone_field(ds: Dataset, field: str, new_field: str) -> Dataset:
    """Copy a field under a new name."""
    field_type(ds.df.schema, field)
    if new_field in ds.df.columns:
        raise ValueError(f"field '{new_field}' exists already")
    return ds.with_df(ds.df.withColumn(new_field, F.col(quoted_path(field))))


# -- samples ------------------------------------------------------------------------


def add_samples(ds: Dataset, samples: Sequence[Mapping] | DataFrame, batch: str) -> Change:
    """Append samples. Each needs a non-empty ``filepath``, else nothing is added.

    The id is a digest of the batch key, the sample's position in the batch and its
    filepath: a retried task makes the same ids, and equal filepaths do not collide
    [chosen]. A DataFrame brings its positions in a unique column ``position``. Fields
    that either side lacks are null.
    """
    if not isinstance(samples, DataFrame):
        records = [dict(s) for s in samples]
        if any(not s.get("filepath") for s in records):
            raise ValueError("every sample needs a 'filepath'")
        names = first_occurrences(n for s in records for n in s)
        columns = {"position": (list(range(len(records))), T.LongType())}
        for name in names:
            given = [s.get(name) for s in records]
            known = name in ds.df.columns
            columns[name] = (given, ds.df.schema[name].dataType if known else _spark_type(ds.spark, given))
        samples = key_table(ds.spark, columns)
    else:
        for name in ("filepath", "position"):
            if name not in samples.columns:
                raise ValueError(f"the batch needs a column '{name}'")
        bad = samples.agg(
            F.count_if(F.coalesce(F.col("filepath"), F.lit("")) == "").alias("n")
        ).first()["n"]
        if bad:
            raise ValueError(f"{bad} samples have no 'filepath'")
    digest = F.md5(
        F.concat_ws("\x1f", F.lit(batch), F.col("position").cast("string"), F.col("filepath"))
    )
    added = samples.withColumn(ds.id_col, digest)
    if "position" not in ds.df.columns:
        added = _placed_last(ds, added).drop("position")
    df = ds.df.withColumn(_TOUCHED, F.lit(False)).unionByName(
        added.withColumn(_TOUCHED, F.lit(True)), allowMissingColumns=True
    )
    return Change(ds.with_df(df))


def _placed_last(ds: Dataset, added: DataFrame) -> DataFrame:
    """Order values that put a batch behind the samples already there, in its own order.

    The first order field that the batch lacks decides. A number goes on counting, a
    date or time goes on in days or microseconds, and a text continues the largest one
    with the position, in twenty digits. Later order fields stay null, since the first
    one already tells the samples apart. In a reversed dataset the batch comes last too.
    Other types raise.
    """
    missing = [n for n in ds.order if n not in added.columns and n != ds.id_col]
    if not missing:
        return added
    name = missing[0]
    dtype, place = ds.df.schema[name].dataType, F.col("position")
    pick, sign = (F.min, -1) if ds.reverse else (F.max, 1)
    last = ds.df.agg(pick(quoted(name))).scalar()
    step = (place + 1) * sign
    if isinstance(dtype, T.NumericType):
        # A type that has no room for the next number raises instead of turning over.
        value = (F.coalesce(last, F.lit(0 if ds.reverse else -1).cast(dtype)) + step).cast(dtype)
    elif isinstance(dtype, T.DateType):
        value = F.date_add(F.coalesce(last, F.lit("1970-01-01").cast(dtype)), step.cast("int"))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        start = F.coalesce(last, F.lit("1970-01-01 00:00:00").cast(dtype))
        value = (start + F.make_dt_interval(secs=(step / 1_000_000).cast("decimal(18,6)"))).cast(dtype)
    elif isinstance(dtype, T.StringType) and not ds.reverse:
        value = F.concat(F.coalesce(last, F.lit("")), F.lpad(place.cast("string"), 20, "0"))
    else:
        raise ValueError(f"samples can't be put behind others by '{name}' of type {dtype.simpleString()}: give its values")
    return added.withColumn(name, value)
