"""View stages that keep or drop fields, nested ones included."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, quoted, require_fields
from ..functions.predicates import part_lists

MANDATORY = ("filepath", "tags")


def _always_kept(ds: Dataset) -> list[str]:
    return [c for c in (ds.id_col, *MANDATORY) if c in ds.df.columns]


def _hide_order(ds: Dataset, dropped: set[str]) -> Dataset:
    """Keep dropped sort columns as private ones, so the view stays ordered."""
    hidden = {c: c if c.startswith("_") else f"_order_{c}" for c in ds.order if c in dropped}
    df = ds.df
    for name, private in hidden.items():
        df = df.withColumnRenamed(name, private)
    return ds.with_df(df, order=tuple(hidden.get(c, c) for c in ds.order))


def _tree(paths: list[str]) -> dict:
    """``["a.b", "a.c", "d"]`` as ``{"a": {"b": {}, "c": {}}, "d": {}}``; ``{}`` = all."""
    tree: dict = {}
    for path in sorted(paths, key=lambda p: p.count(".")):
        node, whole = tree, False
        for i, part in enumerate(path.split(".")):
            if part in node and not node[part] and i < path.count("."):
                whole = True  # a shorter path already covers this one
                break
            node = node.setdefault(part, {})
        if whole:
            continue
    return tree


def _project(value: Column, dtype: T.DataType, keep: dict, path: str | None = None) -> Column:
    """Rebuild a nested value with only the fields of the tree."""
    if not keep:
        return value
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if path is not None and isinstance(element, T.StructType) and not any(keep.values()):
            return F.expr(part_lists(path, [f.name for f in element.fields if f.name in keep]))
        return F.transform(value, lambda x: _project(x, element, keep))
    rebuilt = F.struct(
        *[
            _project(value[f.name], f.dataType, keep[f.name]).alias(f.name)
            for f in dtype.fields
            if f.name in keep
        ]
    )
    return F.when(value.isNotNull(), rebuilt)


def _without(value: Column, dtype: T.DataType, drop: dict) -> Column:
    """A nested value without the fields of the tree."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _without(x, dtype.elementType, drop))
    for name, deeper in drop.items():
        if deeper:
            value = value.withField(name, _without(value[name], dtype[name].dataType, deeper))
        else:
            value = value.dropFields(name)
    return value


def select_fields(ds: Dataset, fields: str | list[str] | None = None) -> Dataset:
    """Keep the listed fields. Id, filepath and tags always stay, and a nested path
    keeps just that part of its field [chosen]. None keeps only the mandatory ones.

    Parts of a label list are read alone from storage; a null in the list becomes a
    label whose fields are null [chosen].
    """
    paths = [fields] if isinstance(fields, str) else list(fields or [])
    require_fields(ds, paths)
    tree = _tree(paths + _always_kept(ds))
    ds = _hide_order(ds, set(ds.public_columns()) - set(tree))
    kept = []
    for f in ds.df.schema.fields:
        if f.name in tree:
            value = _project(F.col(quoted(f.name)), f.dataType, tree[f.name], f.name)
            kept.append(value.alias(f.name))
        elif f.name in ds.order:
            kept.append(F.col(quoted(f.name)))
    return ds.with_df(ds.df.select(*kept), label_fields=None)


def exclude_fields(ds: Dataset, fields: str | list[str]) -> Dataset:
    """Drop the listed fields; a nested path drops just that part of its field.

    Excluding the id, the filepath or the tags is an error [chosen].
    """
    paths = [fields] if isinstance(fields, str) else list(fields)
    require_fields(ds, paths)
    for path in paths:
        if path in _always_kept(ds):
            raise ValueError(f"'{path}' cannot be excluded")
    whole = {p for p in paths if "." not in p}
    ds = _hide_order(ds, whole)
    df = ds.df.drop(*(whole - set(ds.order)))
    for name, drop in _tree([p for p in paths if "." in p]).items():
        if name not in whole:
            dtype = df.schema[name].dataType
            df = df.withColumn(name, _without(F.col(quoted(name)), dtype, drop))
    return ds.with_df(df, label_fields=None)
