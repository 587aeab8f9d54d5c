"""Facet filters: the state of a filter panel, applied to a dataset.

``facet_filter(ds, {path: state})`` with states shaped like

* labels and other values: ``{"values": [...], "exclude": False, "isMatching": False,
  "onlyMatch": False}``
* numbers: ``{"range": [lo, hi], "none": False, "nan": False}``
* booleans: ``{"true": True, "false": False, "none": False}``
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, field_type, list_on_path, quoted_path
from .labels import filter_labels
from .samples import match, match_labels

# The keys of a facet state.
_KEYS = {"values", "exclude", "isMatching", "onlyMatch", "range", "none", "nan", "true", "false"}


def _holds(value: Column, dtype: T.DataType, state: Mapping) -> Column:
    """Whether a value passes the facet; never null."""
    options = []
    if state.get("values"):
        listed = [v for v in state["values"] if v is not None]
        if listed:
            options.append(value.isin(listed))
        if None in state["values"]:
            options.append(value.isNull())
    if state.get("range") is not None:
        lo, hi = state["range"]
        # NaN sorts above every number in Spark, so the upper end already rejects it.
        options.append(value.between(F.lit(lo), F.lit(hi)))
    if state.get("true"):
        options.append(value)
    if state.get("false"):
        options.append(~value)
    if state.get("none"):
        options.append(value.isNull())
    if state.get("nan") and isinstance(dtype, (T.DoubleType, T.FloatType)):
        options.append(F.isnan(value))
    passed = F.lit(False)
    for option in options:
        passed = passed | F.coalesce(option, F.lit(False))
    return ~passed if state.get("exclude") else passed


def _conditions(state: Mapping) -> bool:
    """Whether a facet says anything about values at all."""
    return bool(state.get("values")) or state.get("range") is not None or any(
        state.get(k) for k in ("true", "false", "none", "nan")
    )


def _sample_passes(value: Column, dtype: T.DataType, state: Mapping) -> Column:
    """A list of plain values (tags) passes if one of its elements does."""
    if not isinstance(dtype, T.ArrayType):
        return _holds(value, dtype, state)
    plain = {**state, "exclude": False}
    hit = F.exists(value, lambda v: _holds(v, dtype.elementType, plain))
    hit = F.coalesce(hit, F.lit(False))
    return ~hit if state.get("exclude") else hit


def _label_passes(leaf: str, dtype: T.DataType, state: Mapping) -> Callable[[Column], Column]:
    def passes(label: Column) -> Column:
        for part in leaf.split("."):
            label = label[part]
        return _holds(label, dtype, state)

    return passes


def facet_filter(ds: Dataset, filters: Mapping[str, Mapping]) -> Dataset:
    """Apply all facets.

    A range includes both ends; ``none`` and ``nan`` add the nulls and the NaNs;
    ``exclude`` negates. On a path into a label list ``isMatching`` keeps whole samples
    that have a passing label; otherwise the labels are filtered, and ``onlyMatch``
    drops samples left without one. Elsewhere the facet filters samples [chosen]. A facet
    without a condition, such as ``{}`` or an empty list of values, does not filter.
    """
    for path, state in filters.items():
        unknown = set(state) - _KEYS
        if unknown:
            raise ValueError(f"facet '{path}': unknown keys {', '.join(sorted(unknown))}")
        if not _conditions(state):
            field_type(ds.df.schema, path)
            continue
        list_path, leaf = list_on_path(ds.df.schema, path)
        dtype = field_type(ds.df.schema, path)
        if leaf is None:
            ds = match(ds, _sample_passes(F.col(quoted_path(path)), dtype, state))
        elif state.get("isMatching"):
            ds = match_labels(ds, _label_passes(leaf, dtype, state), fields=list_path)
        else:
            only = bool(state.get("onlyMatch"))
            ds = filter_labels(ds, list_path, _label_passes(leaf, dtype, state), only)
    return ds
