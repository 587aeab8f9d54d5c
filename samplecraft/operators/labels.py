"""View stages that work inside label lists.

They use ``filter``/``transform``/``exists`` on the nested column: no shuffle, list
order kept, and one sample stays one row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dataset import (
    Dataset,
    field_type,
    is_label_list,
    quoted,
    quoted_path,
    require_fields,
    with_path,
)
from ..functions.predicates import LabelPredicate, any_label, has_tags, keep_labels


def _has_label(field: str) -> Column:
    return F.coalesce(F.size(F.col(quoted_path(field))) > 0, F.lit(False))


def filter_labels(
    ds: Dataset, field: str, filter: LabelPredicate, only_matches: bool = True
) -> Dataset:
    """Keep the labels that satisfy the predicate.

    With ``only_matches`` samples left without a label are dropped [chosen].
    """
    require_fields(ds, [field])
    # Asked before the list is rebuilt: the test stops at the first label that passes.
    df = ds.df.filter(any_label(ds.df.schema, field, filter)) if only_matches else ds.df
    return ds.with_df(with_path(df, field, keep_labels(field, filter)))


def select_labels(
    ds: Dataset,
    tags: str | list[str] | None = None,
    fields: str | list[str] | None = None,
) -> Dataset:
    """Keep only the labels with any of ``tags`` in ``fields``.

    Other label fields are dropped, and so are samples left without a label. None
    means any tag, or every label field [chosen].
    """
    lists = ds.label_lists()
    names = [fields] if isinstance(fields, str) else list(fields or lists)
    if not names:
        raise ValueError("the dataset has no label field")
    require_fields(ds, names)
    df = ds.df.drop(*[f for f in lists if f not in names])
    if tags is not None:
        wanted = [tags] if isinstance(tags, str) else list(tags)
        for name in names:
            kept = F.filter(F.col(quoted_path(name)), lambda l: has_tags(l["tags"], wanted))
            df = with_path(df, name, kept)
    any_left = F.lit(False)
    for name in names:
        any_left = any_left | _has_label(name)
    declared = None if ds.label_fields is None else tuple(names)
    return ds.with_df(df.filter(any_left), label_fields=declared)


def limit_labels(ds: Dataset, field: str, limit: int) -> Dataset:
    """Keep the first ``limit`` labels of the list; 0 or less leaves an empty list."""
    require_fields(ds, [field])
    return ds.with_df(
        with_path(ds.df, field, F.slice(F.col(quoted_path(field)), 1, max(limit, 0)))
    )


def lookup(value: Column, mapping: Mapping) -> Column:
    """Map a value through a small dict; unmapped values and null stay."""
    if not mapping:
        return value
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def map_labels(ds: Dataset, field: str, map: Mapping[str, str]) -> Dataset:
    """Rename label values; unmapped values stay as they are [chosen]."""
    dtype = field_type(ds.df.schema, field)
    if not is_label_list(dtype):
        raise ValueError(f"'{field}' is not a list of labels")
    renamed = F.transform(
        F.col(quoted_path(field)), lambda l: l.withField("label", lookup(l["label"], map))
    )
    return ds.with_df(with_path(ds.df, field, renamed))


def to_patches(ds: Dataset, field: str) -> Dataset:
    """One row per label: ``patch_id`` (the label's id), the sample's id and filepath,
    and the label itself under the field's last name [chosen columns].

    An empty or null list gives no row. Patches are ordered by sample, then by place
    in the list.
    """
    dtype = field_type(ds.df.schema, field)
    if not is_label_list(dtype) or "id" not in dtype.elementType.fieldNames():
        raise ValueError(f"'{field}' is not a list of labels with ids")
    label = field.split(".")[-1]
    carried = [c for c in dict.fromkeys((ds.id_col, "filepath", *ds.order)) if c in ds.df.columns]
    patches = ds.df.select(
        *[quoted(c) for c in carried],
        F.posexplode(F.col(quoted_path(field))).alias("_place", label),
    ).withColumn("patch_id", F.col(quoted(label))["id"])
    order = tuple(dict.fromkeys((*ds.order, ds.id_col, "_place")))
    return ds.with_df(
        patches.select("patch_id", *[quoted(c) for c in patches.columns if c != "patch_id"]),
        id_col="patch_id",
        order=order,
        label_fields=(),
    )
