"""The dataset: a table of samples plus the few facts Spark cannot keep in it.

A :class:`Dataset` wraps a lazy ``DataFrame``. Views are datasets too: every stage
takes a dataset and returns another one, so chaining stages is ordinary function
composition and Catalyst sees one logical plan.

Order is explicit. ``order`` names the sort columns and the id always breaks ties,
so "the first n samples" means the same on every run and at every partitioning.
Nothing is sorted until a limit, a skip, a position or the sink asks for it.

Columns whose name starts with ``_`` are private: stages use them to carry a sort
key, and :meth:`Dataset.rows` hides them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = "_order"
_META_KEY = "dataset"


class FieldNotFound(ValueError):
    """A field path does not exist in the dataset's schema."""


@dataclass(frozen=True)
class Dataset:
    df: DataFrame
    id_col: str = "sample_id"
    order: tuple[str, ...] = ()
    reverse: bool = False
    label_fields: tuple[str, ...] | None = None
    name: str | None = None
    media_type: str | None = None
    tags: tuple[str, ...] = ()
    info: Mapping[str, object] = field(default_factory=dict)
    runs: Mapping[str, DataFrame] = field(default_factory=dict)
    # Of a view that only filters: the table it filters, and the condition.
    filtered: tuple[DataFrame, Column] | None = field(default=None, compare=False, repr=False)

    def __post_init__(self):
        for column in (self.id_col, *self.order):
            if column not in self.df.columns:
                raise FieldNotFound(f"dataset has no column '{column}'")

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def with_df(self, df: DataFrame, **changes) -> "Dataset":
        return replace(self, df=df, filtered=None, **changes)

    def keep(self, condition: Column) -> "Dataset":
        """The samples for which the condition is true. A chain of these remembers its
        condition, so that a mutation can flag the view's samples without a join."""
        table, before = self.filtered or (self.df, None)
        both = condition if before is None else before & condition
        return replace(self, df=self.df.filter(condition), filtered=(table, both))

    def with_run(self, key: str, matches: DataFrame) -> "Dataset":
        """Attach an evaluation's match table under a key."""
        return replace(self, runs={**self.runs, key: matches})

    # -- order ---------------------------------------------------------------

    def order_columns(self) -> list[Column]:
        """The whole sort key, unique because it ends in the id."""
        names = [c for c in self.order if c != self.id_col]
        return [F.col(quoted(c)) for c in (*names, self.id_col)]

    def order_key(self) -> Column:
        """The sort key as one struct.

        Spark compares structs field by field with nulls lowest, which is also its
        ascending sort order, so the smallest key is the first sample's.
        """
        return F.struct(*self.order_columns())

    def sort_columns(self) -> list[Column]:
        return [c.desc() if self.reverse else c.asc() for c in self.order_columns()]

    # -- leaving the library -------------------------------------------------

    def public_columns(self) -> list[str]:
        return [c for c in self.df.columns if not c.startswith("_")]

    def rows(self) -> DataFrame:
        """The samples without private columns, in no particular order."""
        return self.df.select(*[quoted(c) for c in self.public_columns()])

    def sorted_rows(self) -> DataFrame:
        """The samples in dataset order (a full sort: use it at the sink only)."""
        return self.df.orderBy(*self.sort_columns()).select(
            *[quoted(c) for c in self.public_columns()]
        )

    # -- labels --------------------------------------------------------------

    def label_lists(self) -> list[str]:
        """Declared label fields, or every top-level list of structs with a ``label``."""
        if self.label_fields is not None:
            return list(self.label_fields)
        return [f.name for f in self.df.schema.fields if is_label_list(f.dataType)]

    # -- definition kept in the table ----------------------------------------

    def stamped(self) -> DataFrame:
        """The table with the dataset's definition in the id column's metadata.

        Spark keeps column metadata in views and in Parquet files, so a dataset
        comes back from either with its order and label fields.
        """
        definition = {
            "id_col": self.id_col,
            "order": list(self.order),
            "reverse": self.reverse,
            "label_fields": None if self.label_fields is None else list(self.label_fields),
            "name": self.name,
            "media_type": self.media_type,
            "tags": list(self.tags),
            "info": dict(self.info),
        }
        metadata = {**self.df.schema[self.id_col].metadata, _META_KEY: json.dumps(definition)}
        return self.df.withMetadata(self.id_col, metadata)

    @staticmethod
    def from_df(df: DataFrame, **overrides) -> "Dataset":
        """Read back a :meth:`stamped` table; keyword arguments win over the stamp."""
        known = stored_definition(df)
        known["order"] = tuple(known.get("order", ()))
        known["tags"] = tuple(known.get("tags", ()))
        if known.get("label_fields") is not None:
            known["label_fields"] = tuple(known["label_fields"])
        known.update(overrides)
        return Dataset(df, **known)


def stored_definition(df: DataFrame) -> dict:
    """What :meth:`Dataset.stamped` recorded in a table; empty if nothing."""
    for f in df.schema.fields:
        if _META_KEY in f.metadata:
            return json.loads(f.metadata[_META_KEY])
    return {}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted_path(path: str) -> str:
    return ".".join(quoted(p) for p in path.split("."))


def is_label_list(dtype: T.DataType) -> bool:
    return (
        isinstance(dtype, T.ArrayType)
        and isinstance(dtype.elementType, T.StructType)
        and "label" in dtype.elementType.fieldNames()
    )


def field_type(schema: T.StructType, path: str) -> T.DataType:
    """Type at a dotted path. Steps may pass through lists of structs."""
    dtype: T.DataType = schema
    for part in path.split("."):
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            raise FieldNotFound(f"no field '{path}' in the dataset")
        dtype = dtype[part].dataType
    return dtype


def require_fields(ds: Dataset, paths: Sequence[str]) -> None:
    for path in paths:
        field_type(ds.df.schema, path)


def list_on_path(schema: T.StructType, path: str) -> tuple[str, str | None]:
    """Split a path at the first list of structs on it: ``(list path, rest)``.

    ``rest`` is None when the path does not pass through such a list.
    """
    parts = path.split(".")
    for i in range(1, len(parts)):
        head = ".".join(parts[:i])
        dtype = field_type(schema, head)
        if isinstance(dtype, T.ArrayType):
            field_type(schema, path)
            return head, ".".join(parts[i:])
    field_type(schema, path)
    return path, None


def with_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Replace the field at a (struct-)nested path."""
    top, _, rest = path.partition(".")
    if not rest:
        return df.withColumn(top, value)
    return df.withColumn(top, F.col(quoted(top)).withField(rest, value))


def resolve_path(df: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """The value stream of a dotted path: one row per value, in column ``value``.

    Every list on the path, the last one included, is unwound. Empty and null lists
    give no value; a null inside a list, or a null scalar, is a value [chosen].

    Only the leaf is selected before a list is unwound, so the scan reads just that
    leaf of the nested column.
    """
    kept = [F.col(quoted(c)) for c in keep]
    parts = path.split(".")
    schema = df.schema
    if parts[0] not in schema.fieldNames():
        raise FieldNotFound(f"no field '{path}' in the dataset")
    value, dtype = F.col(quoted(parts[0])), schema[parts[0]].dataType

    def unwound(source: DataFrame, lists: Column) -> DataFrame:
        return source.select(*kept, F.explode(lists).alias("value"))

    for part in parts[1:]:
        while isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType):
            df, value, dtype = unwound(df, value), F.col("value"), dtype.elementType
        inside = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype
        if not isinstance(inside, T.StructType) or part not in inside.fieldNames():
            raise FieldNotFound(f"no field '{path}' in the dataset")
        value = value.getField(part)
        leaf = inside[part].dataType
        dtype = T.ArrayType(leaf) if isinstance(dtype, T.ArrayType) else leaf
    while isinstance(dtype, T.ArrayType):
        df, value, dtype = unwound(df, value), F.col("value"), dtype.elementType
    return df.select(*kept, value.alias("value"))


@dataclass(frozen=True)
class Listed:
    """A path's values in one row: an array that is never null, and the values' type."""

    column: Column
    dtype: T.DataType


def listed(df: DataFrame, path: str) -> Listed:
    """The values that ``resolve_path`` gives, as one array for each row."""
    parts = path.split(".")
    if parts[0] not in df.schema.fieldNames():
        raise FieldNotFound(f"no field '{path}' in the dataset")
    value, dtype, many = F.col(quoted(parts[0])), df.schema[parts[0]].dataType, False
    for part in [*parts[1:], None]:
        while isinstance(dtype, T.ArrayType):
            if many:
                value = F.flatten(F.filter(value, F.isnotnull))
            value, dtype, many = F.coalesce(value, F.array().cast(dtype)), dtype.elementType, True
        if part is None:
            break
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            raise FieldNotFound(f"no field '{path}' in the dataset")
        value, dtype = value.getField(part), dtype[part].dataType
    return Listed(value if many else F.array(value), dtype)
