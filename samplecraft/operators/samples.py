"""View stages that keep or drop whole samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dataset import ORDER, Dataset, field_type, quoted, quoted_path, require_fields, with_path
from ..functions.predicates import (
    LabelPredicate,
    any_label,
    has_tags,
    sample_predicate,
)
from ..plans.keylists import INLINE_VALUES, first_occurrences, keys_with_position, typed_keys


def match(ds: Dataset, filter: Column | str) -> Dataset:
    """Keep samples where the predicate is true; null counts as false."""
    return ds.keep(sample_predicate(filter))


def match_labels(
    ds: Dataset,
    filter: LabelPredicate,
    fields: str | list[str] | None = None,
    bool: bool = True,
) -> Dataset:
    """Keep samples with a label satisfying the predicate in any of ``fields``.

    ``fields=None`` means every label field. ``bool=False`` keeps the other samples,
    those with a null label list included. Labels are left as they are [chosen].
    """
    names = [fields] if isinstance(fields, str) else fields or ds.label_lists()
    if not names:
        raise ValueError("the dataset has no label field")
    require_fields(ds, names)
    found = F.lit(False)
    for name in names:
        found = found | any_label(ds.df.schema, name, filter)
    return ds.keep(found if bool else ~found)


def match_tags(
    ds: Dataset, tags: str | list[str], bool: bool = True, all: bool = False
) -> Dataset:
    """Keep samples with any (``all=True``: every one) of the tags.

    ``bool=False`` keeps the others. A null tag list holds no tag [chosen].
    """
    require_fields(ds, ["tags"])
    wanted = first_occurrences([tags] if isinstance(tags, str) else tags)
    found = has_tags(F.col("tags"), wanted, all)
    return ds.keep(found if bool else ~found)


def filter_field(
    ds: Dataset, field: str, filter: Column | str, only_matches: bool = True
) -> Dataset:
    """Keep a field's value where the predicate is true.

    By default samples that fail are dropped; ``only_matches=False`` keeps them with
    the field set to null [chosen].
    """
    require_fields(ds, [field])
    keep = sample_predicate(filter)
    if only_matches:
        return ds.keep(keep)
    return ds.with_df(with_path(ds.df, field, F.when(keep, F.col(quoted_path(field)))))


def exists(ds: Dataset, field: str, bool: bool = True) -> Dataset:
    """Keep samples whose field is not null (``bool=False``: null).

    An empty list, an empty string and NaN exist [chosen].
    """
    require_fields(ds, [field])
    value = F.col(quoted_path(field))
    return ds.keep(value.isNotNull() if bool else value.isNull())


def _select_keys(ds: Dataset, field: str, keys, ordered: bool) -> Dataset:
    dtype = field_type(ds.df.schema, field)
    value = F.col(quoted_path(field))
    if not isinstance(keys, DataFrame):
        keys = typed_keys(keys, dtype)
        if not ordered and len(keys) <= INLINE_VALUES:
            # A literal list reaches the Parquet scan as a pushed-down filter.
            return ds.keep(value.isin(keys) if keys else F.lit(False))
    if not ordered and isinstance(keys, DataFrame):
        # A semi-join does not mind repeated keys: no need to shuffle them apart first.
        wanted = keys.select(F.col(quoted(keys.columns[0])).cast(dtype).alias("_key"))
    else:
        wanted = keys_with_position(ds.spark, keys, dtype, ordered)
    # No broadcast hint: the key list may be long. Spark broadcasts it only when its
    # known size allows; otherwise adaptive execution splits a skewed field value.
    on = value == F.col("_key")
    if not ordered:
        return ds.with_df(ds.df.join(wanted, on, "left_semi"))
    placed = ds.df.drop(ORDER).join(wanted, on).drop("_key")
    return ds.with_df(
        placed.withColumnRenamed("_position", ORDER), order=(ORDER,), reverse=False
    )


def select(ds: Dataset, sample_ids, ordered: bool = False) -> Dataset:
    """Keep the listed ids: a list, or a DataFrame with the ids in its first column.

    ``ordered`` puts the samples in list order. A repeated id keeps its first place,
    unknown ids and None are ignored [chosen].
    """
    if not isinstance(sample_ids, DataFrame):
        if isinstance(sample_ids, str):
            sample_ids = [sample_ids]
    return _select_keys(ds, ds.id_col, sample_ids, ordered)


def select_by(ds: Dataset, field: str, values, ordered: bool = False) -> Dataset:
    """Keep samples whose field has one of the values; ``ordered``: in value order,
    samples of one value by id [chosen]. None selects nothing, and a value that is not
    of the field's type raises."""
    require_fields(ds, [field])
    return _select_keys(ds, field, values, ordered)


def select_group_slices(
    ds: Dataset, slices: str | list[str] | None = None, media_type: str | None = None
) -> Dataset:
    """Flatten grouped samples, keeping the given slices and/or media type.

    Groups are columns ``group_id``, ``slice`` and ``media_type``; None means all.
    """
    kept = F.lit(True)
    if slices is not None:
        require_fields(ds, ["slice"])
        kept = kept & F.col("slice").isin([slices] if isinstance(slices, str) else list(slices))
    if media_type is not None:
        require_fields(ds, ["media_type"])
        kept = kept & (F.col("media_type") == media_type)
    return ds.keep(kept)


def filter_view(
    ds: Dataset,
    filters: dict | None = None,
    match: Column | str | None = None,
    exists: str | list[str] | None = None,
    tags: str | list[str] | None = None,
    sample_ids=None,
    limit: int | None = None,
) -> Dataset:
    """The convenience filter: all given conditions hold.

    ``filters`` are equalities per field (None matches null); then ``match``,
    ``exists``, any of ``tags`` and ``sample_ids``; ``limit`` keeps the first samples.
    """
    from .ordering import limit as limit_samples

    kept = F.lit(True)
    for path, value in (filters or {}).items():
        require_fields(ds, [path])
        kept = kept & F.col(quoted_path(path)).eqNullSafe(F.lit(value))
    if match is not None:
        kept = kept & sample_predicate(match)
    for path in [exists] if isinstance(exists, str) else exists or []:
        require_fields(ds, [path])
        kept = kept & F.col(quoted_path(path)).isNotNull()
    if tags:
        kept = kept & has_tags(F.col("tags"), [tags] if isinstance(tags, str) else list(tags))
    view = ds.keep(kept)
    if sample_ids is not None:
        view = select(view, sample_ids)
    return view if limit is None else limit_samples(view, limit)


def id_flag(ds: Dataset, view: Dataset | None, sample_ids, flag: str) -> DataFrame:
    """``ds.df`` with a boolean column that marks the selected samples.

    ``sample_ids`` wins over ``view``; an empty list selects nobody, and neither given
    selects everybody.
    """
    ident = F.col(quoted(ds.id_col))
    if sample_ids is not None and not isinstance(sample_ids, DataFrame):
        keys = typed_keys(sample_ids, ds.df.schema[ds.id_col].dataType)
        if len(keys) <= INLINE_VALUES:
            chosen = F.coalesce(ident.isin(keys), F.lit(False)) if keys else F.lit(False)
            return ds.df.withColumn(flag, chosen)
        sample_ids = keys
    if sample_ids is None and view is None:
        return ds.df.withColumn(flag, F.lit(True))
    if sample_ids is None:
        if view.filtered is not None and view.filtered[0] is ds.df:
            # The view only filters this very table: its condition is the flag.
            return ds.df.withColumn(flag, F.coalesce(view.filtered[1], F.lit(False)))
        sample_ids = view.df.select(quoted(view.id_col))
    dtype = ds.df.schema[ds.id_col].dataType
    wanted = keys_with_position(ds.spark, sample_ids, dtype, False).select(
        "_key", F.lit(True).alias("_hit")
    )
    return (
        ds.df.join(wanted, ident == F.col("_key"), "left")
        .withColumn(flag, F.coalesce("_hit", F.lit(False)))
        .drop("_key", "_hit")
    )
