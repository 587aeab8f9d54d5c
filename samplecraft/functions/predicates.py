"""Predicates on samples and on the labels inside them.

A sample predicate is a ``Column`` or a Spark SQL string. A label predicate is a
callable on the label struct (``lambda l: l["confidence"] > 0.5``) or a Spark SQL
string in which ``l`` names the label (``"l.confidence > 0.5"``). Nothing is ever
evaluated as Python source.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import field_type, quoted, quoted_path

LabelPredicate = Callable[[Column], Column] | str


def sample_predicate(predicate: Column | str) -> Column:
    if isinstance(predicate, Column):
        return predicate
    if isinstance(predicate, str):
        return F.expr(predicate)
    raise ValueError(f"expected a Column or a SQL string, got {type(predicate).__name__}")


def keep_labels(field: str, predicate: LabelPredicate) -> Column:
    """The label list at ``field`` without the labels that fail the predicate."""
    if isinstance(predicate, str):
        return F.expr(f"filter({quoted_path(field)}, l -> {predicate})")
    if not callable(predicate):
        raise ValueError("a label predicate is a callable or a SQL string over 'l'")
    return F.filter(F.col(quoted_path(field)), predicate)


class _Reader:
    """Stands in for a label while a predicate is asked which fields it reads."""

    def __init__(self):
        self.fields: set[str] = set()

    def __getitem__(self, name: str) -> Column:
        self.fields.add(name)
        return F.col(quoted(name))


def fields_read(predicate: LabelPredicate) -> set[str] | None:
    """The label fields a predicate reads; None if it may read the label as a whole."""
    if isinstance(predicate, str):
        if re.search(r"\bl\b(?!\s*\.\s*\w)", predicate):
            return None
        return set(re.findall(r"\bl\s*\.\s*(\w+)", predicate)) or None
    reader = _Reader()
    try:
        predicate(reader)
    except Exception:
        return None
    return reader.fields or None


def part_lists(path: str, names: list[str]) -> str:
    """SQL for the label list at a path with only the named fields.

    Built from one list per field, which the scan can read alone; rebuilding the labels
    one by one would read them whole.
    """
    return f"arrays_zip({', '.join(quoted_path(f'{path}.{name}') for name in names)})"


def any_label(schema: T.StructType, field: str, predicate: LabelPredicate) -> Column:
    """True if some label passes; a null list, or null answers only, count as no."""
    if not isinstance(predicate, str) and not callable(predicate):
        raise ValueError("a label predicate is a callable or a SQL string over 'l'")
    element = field_type(schema, field).elementType
    known = element.fieldNames() if isinstance(element, T.StructType) else []
    read = fields_read(predicate)
    labels = quoted_path(field)
    if read is not None and read < set(known):
        labels = part_lists(field, [name for name in known if name in read])
    if callable(predicate):
        found = F.exists(F.expr(labels), predicate)
    else:
        found = F.expr(f"exists({labels}, l -> {predicate})")
    return F.coalesce(found, F.lit(False))


def text_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def has_tags(tags: Column, wanted: list[str], all: bool = False) -> Column:
    """Whether a tag list holds any (or all) of the wanted tags; null list: no."""
    if all:
        found = F.size(F.array_except(text_array(wanted), tags)) == 0
    else:
        found = F.arrays_overlap(tags, text_array(wanted))
    return F.coalesce(found, F.lit(False))
