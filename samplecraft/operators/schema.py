"""Field schemas: describing, declaring and inferring fields."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, field_type, quoted_path
from ..plans.keylists import key_table

GEO_POINT = T.StructType(
    [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]
)

# The declarable field types and the Spark type of each.
FIELD_TYPES = {
    "BooleanField": T.BooleanType(),
    "DateTimeField": T.TimestampType(),
    "EmbeddedDocumentField": T.StructType(),
    "FloatField": T.DoubleType(),
    "GeoPointField": GEO_POINT,
    "IntField": T.LongType(),
    "ListField": T.ArrayType(T.StringType()),
    "StringField": T.StringType(),
}


def field_type_name(dtype: T.DataType) -> str:
    """The declarable type that describes a Spark type."""
    if isinstance(dtype, T.ArrayType):
        return "ListField"
    if isinstance(dtype, T.StructType):
        return "GeoPointField" if dtype.fieldNames() == ["lon", "lat"] else "EmbeddedDocumentField"
    if isinstance(dtype, T.BooleanType):
        return "BooleanField"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "DateTimeField"
    if isinstance(dtype, T.IntegralType):
        return "IntField"
    if isinstance(dtype, T.NumericType):
        return "FloatField"
    return "StringField"


_SCHEMA_COLUMNS = {
    "scope": T.StringType(),
    "field": T.StringType(),
    "type": T.StringType(),
    "description": T.StringType(),
    "required": T.BooleanType(),
    "read_only": T.BooleanType(),
    "subfield": T.StringType(),
    "embedded_doc_type": T.StringType(),
}


def _describe(f: T.StructField, scope: str) -> tuple:
    inner = f.dataType
    subfield = None
    if isinstance(inner, T.ArrayType):
        inner = inner.elementType
        subfield = field_type_name(inner)
    document = None
    if field_type_name(inner) == "EmbeddedDocumentField":
        document = f.metadata.get("embedded_doc_type") or inner.simpleString()
    return (
        scope,
        f.name,
        field_type_name(f.dataType),
        f.metadata.get("description"),
        not f.nullable,
        bool(f.metadata.get("read_only", False)),
        subfield,
        document,
    )


def get_field_schema(
    ds: Dataset, include_private: bool = False, frames: DataFrame | None = None
) -> DataFrame:
    """One row per field: scope (``sample`` or ``frame``), field, type, description,
    required, read_only, subfield, embedded_doc_type.

    Fields that start with ``_`` appear on request. ``frames`` is the child table of a
    video dataset; its fields get the scope ``frame``.
    """
    rows = []
    for scope, df in (("sample", ds.df), ("frame", frames)):
        if df is not None:
            rows += [
                _describe(f, scope)
                for f in df.schema.fields
                if include_private or not f.name.startswith("_")
            ]
    return key_table(
        ds.spark,
        {
            name: ([row[i] for row in rows], dtype)
            for i, (name, dtype) in enumerate(_SCHEMA_COLUMNS.items())
        },
    )


def declared_type(
    type_name: str,
    embedded_doc_type: T.StructType | str | None = None,
    subfield: str | None = None,
) -> T.DataType:
    """The Spark type of a declaration."""
    for role, name in (("field type", type_name), ("subfield type", subfield)):
        if name is not None and name not in FIELD_TYPES:
            raise ValueError(f"unknown {role} '{name}', expected one of {', '.join(FIELD_TYPES)}")
    document = embedded_doc_type
    if isinstance(document, str):
        document = T.StructType.fromDDL(document)
    inner = subfield if type_name == "ListField" else type_name
    dtype = FIELD_TYPES[inner] if inner is not None else T.StringType()
    if inner == "EmbeddedDocumentField":
        if document is None:
            raise ValueError("an embedded document needs embedded_doc_type")
        dtype = document
    return T.ArrayType(dtype) if type_name == "ListField" else dtype


def add_sample_field(
    ds: Dataset,
    field_name: str,
    field_type: str,
    embedded_doc_type: T.StructType | str | None = None,
    subfield: str | None = None,
    description: str | None = None,
) -> Dataset:
    """Add a typed field filled with null.

    An embedded document is given as a ``StructType`` or a DDL string. A field that
    exists with the same type is left alone; with another type it is an error [chosen].
    """
    dtype = declared_type(field_type, embedded_doc_type, subfield)
    if field_name in ds.df.columns:
        have = ds.df.schema[field_name].dataType
        if field_type_name(have) != field_type or (
            isinstance(have, (T.ArrayType, T.StructType)) and have.simpleString() != dtype.simpleString()
        ):
            raise ValueError(f"field '{field_name}' exists with type {have.simpleString()}")
        return ds
    metadata = {} if description is None else {"description": description}
    column = F.lit(None).cast(dtype).alias(field_name, metadata=metadata)
    return ds.with_df(ds.df.select("*", column))


FIELDS = 5_000  # fields that an inferred document may have in all

_SIMPLE = {
    "BIGINT": T.LongType(),
    "BINARY": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


KNOWN = 1_000  # schemas of rows that a task remembers, so as not to read them again


def _word_type(word: str) -> str:
    """A leaf's kind; decimals and floats are one."""
    return "DOUBLE" if word.startswith("DECIMAL") or word == "FLOAT" else word


class _VariantPaths:
    """Reads a variant's schema, ``OBJECT<name: TYPE, ...>``, into pairs of path and kind.
    A path's steps are ``.name`` and ``[]``. Names stand where the grammar has names, so a
    key may be called like a type."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _take(self, what: str) -> bool:
        if self.text.startswith(what, self.at):
            self.at += len(what)
            return True
        return False

    def _name(self) -> str:
        if not self._take("`"):
            end = self.text.index(":", self.at)
            name, self.at = self.text[self.at : end], end
            return name
        name = ""
        while True:
            end = self.text.index("`", self.at)
            name, self.at = name + self.text[self.at : end], end + 1
            if not self._take("`"):
                return name
            name += "`"

    def pairs(self, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], str]]:
        if self._take("OBJECT<"):
            yield path, "OBJECT"
            while not self._take(">"):
                self._take(", ")
                name = self._name()
                self._take(": ")
                yield from self.pairs((*path, f".{name}"))
        elif self._take("ARRAY<"):
            yield path, "ARRAY"
            yield from self.pairs((*path, "[]"))
            self._take(">")
        else:
            word = re.compile(r"[A-Z_]+(\(\d+, ?\d+\))?").match(self.text, self.at)
            self.at = word.end()
            yield path, _word_type(word[0])


def _is_field(path) -> bool:
    return bool(path) and path[-1] != "[]"


def _with_elements(path: tuple[str, ...], kind: str) -> tuple[tuple[str, ...], str]:
    """The path of the field itself, and the kind behind a ``[]`` for each list around it."""
    end = len(path)
    while end and path[end - 1] == "[]":
        end -= 1
    return path[:end], "[]" * (len(path) - end) + kind


def _profiled(schemas: Iterable[str], max_fields: int) -> set[tuple[tuple[str, ...], str]]:
    """The paths and kinds of all schemas, read until there are more than ``max_fields``
    different fields."""
    found: set = set()
    fields: set = set()
    known: set = set()
    for text in schemas:
        if text in known:
            continue
        if len(known) >= KNOWN:
            known.clear()
        known.add(text)
        for path, kind in _VariantPaths(text).pairs():
            found.add((path, kind))
            if _is_field(path):
                fields.add(path)
                if len(fields) > max_fields:
                    return found
    return found


def _merged(kinds: dict[tuple[str, ...], set[str]]) -> T.DataType:
    """The Spark type of a profile. Nothing but nulls, or values without one type, stay
    text; whole numbers and others together are doubles."""
    below: dict = {}
    for path in kinds:
        if path:
            below.setdefault(path[:-1], []).append(path)

    def typed(path):
        own = kinds[path] - {"VOID"}
        if own == {"OBJECT"}:
            inner = sorted(p for p in below.get(path, []) if _is_field(p))
            return T.StructType([T.StructField(p[-1][1:], typed(p)) for p in inner])
        if own == {"ARRAY"}:
            return T.ArrayType(typed((*path, "[]")))
        if own == {"BIGINT", "DOUBLE"}:
            own = {"DOUBLE"}
        return _SIMPLE.get(own.pop(), T.StringType()) if len(own) == 1 else T.StringType()

    return typed(())


def infer_fields(ds: Dataset, field: str, into: str | None = None, max_fields: int = FIELDS) -> Dataset:
    """Turn a JSON text field into a typed one.

    The schema is merged over all rows that hold a JSON object; the result is the struct
    field ``into`` (default: the field itself). Text that is no JSON, or JSON that is no
    object, gives null; without any object it raises. Decimals become doubles, values of
    mixed types stay text. JSON that is used as a map, so with more than ``max_fields``
    different fields in all, at whatever depth, raises.

    One pass: every task reads its rows' schemas into a profile of paths and kinds and
    stops when that has more fields than allowed; the profiles' distinct rows are merged,
    and no more than the limit reaches the driver.
    """
    field_type(ds.df.schema, field)
    text = F.col(quoted_path(field))
    schemas = ds.df.select(F.schema_of_variant(F.try_parse_json(text)).alias("s")).filter(F.col("s").startswith("OBJECT<"))

    def profile(batches):
        found = _profiled((s for batch in batches for s in batch.column("s").to_pylist()), max_fields)
        # A list's elements go with the field, so that there is a row for each field.
        rows = sorted({_with_elements(path, kind) for path, kind in found})
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(p) for p, _ in part], pa.list_(pa.string())), pa.array([k for _, k in part], pa.string())],
                ["path", "kind"],
            )

    paths = schemas.mapInArrow(profile, "path array<string>, kind string").groupBy("path").agg(F.collect_set("kind").alias("kinds"))
    merged = paths.limit(max_fields + 2).collect()  # the fields, and the object itself
    if not merged:
        raise ValueError(f"'{field}' does not hold JSON objects")
    if len(merged) > max_fields + 1:
        raise ValueError(f"'{field}' has more than {max_fields} fields")
    kinds: dict = {}
    for row in merged:
        for kind in row.kinds:
            word = kind.lstrip("[]")
            kinds.setdefault((*row.path, *["[]"] * ((len(kind) - len(word)) // 2)), set()).add(word)
    return ds.with_df(ds.df.withColumn(into or field, F.from_json(text, _merged(kinds))))
