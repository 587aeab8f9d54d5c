"""Datasets that are changed and added to without being written again.

A store is a folder. Its samples lie in data folders, one for each batch; a change writes
only ``(id, version, set_<field>)`` rows of the samples it touches, into a folder of its own.
``log`` has one small file for each version, which names that folder: a version is there once
its log entry is, so a write that failed half-way leaves files that nobody reads. Folders are
never written twice, so a result that is being computed keeps its files.

Reading version n is one scan of the samples and one of all changes up to n, which are
aggregated to the latest value of each field of an id and joined to the samples once.
``compact`` writes this result as new samples, from which later versions start. A change
whose rows are few next to the samples costs in proportion to itself when it is written; what
changes cost when they are read is what compaction ends.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..dataset import Dataset, field_type, quoted, quoted_path, stored_definition, with_path
from ..operators import mutations

_LOG = "version long, kind string, folder string, batch string, field string, type string, reset boolean, n long, rows long, schema string"
_VERSION, _ADDED, _BATCH, _ID = "_version", "_added", "_batch", "_id"


def _set(field: str) -> str:
    return f"set_{field}"


@dataclass(frozen=True)
class Entry:
    """One version in the log. ``kind`` is samples, change or compact; ``n`` is the count
    the operation reports, ``rows`` what it wrote."""

    version: int
    kind: str
    folder: str
    batch: str | None
    field: str | None
    type: str | None
    reset: bool
    n: int
    rows: int
    schema: str | None


@dataclass(frozen=True)
class Store:
    """Handle on a store; it holds no state, so every call reads the log."""

    spark: SparkSession
    path: str

    # -- reading ---------------------------------------------------------------------

    def entries(self, version: int | None = None) -> list[Entry]:
        """The log up to a version, in order: one entry for each version ever made."""
        log = self.spark.read.schema(_LOG).json(f"{self.path}/log/*")
        found = sorted((Entry(**r.asDict()) for r in log.collect()), key=lambda e: e.version)
        if version is not None and version not in {e.version for e in found}:
            raise ValueError(f"no version {version}, have 0 to {found[-1].version}")
        return [e for e in found if version is None or e.version <= version]

    def version(self) -> int:
        return self.entries()[-1].version

    def history(self) -> DataFrame:
        """``version, kind, batch, field, n, rows``: what each version counted and wrote."""
        rows = [(e.version, e.kind, e.batch, e.field, e.n, e.rows) for e in self.entries()]
        return self.spark.createDataFrame(rows, "version long, kind string, batch string, field string, n long, rows long")

    def dataset(self, version: int | None = None) -> Dataset:
        """The dataset as of a version; None is the latest."""
        found = self._read(self.entries(version))
        return found.with_df(found.df.drop(_BATCH))

    def _read(self, log: list[Entry], without: str | None = None) -> Dataset:
        """The dataset of these entries, without one batch if named. Its samples carry
        their batch in a private column."""
        start = max(i for i, e in enumerate(log) if e.kind == "compact")
        log = log[start:]
        batches = {e.batch: e for e in log if e.kind == "samples" and e.batch != without}
        df = self._samples([log[0], *batches.values()])
        again = {e.batch for e in log if e.kind == "samples"} | {without} - {None}
        if again:  # batches that were compacted before they were added once more
            old = (F.col(_ADDED) == log[0].version) & F.col(_BATCH).isin(list(again))
            df = df.filter(~F.coalesce(old, F.lit(False)))
        known = stored_definition(df)
        changes = [e for e in log if e.kind == "change"]
        if changes:
            df = self._merged(df, known["id_col"], changes)
        # The definition travels on the id column of the first data folder.
        return Dataset.from_df(df.drop(_ADDED), **{k: tuple(v) if isinstance(v, list) else v for k, v in known.items()})

    def _samples(self, entries: list[Entry]) -> DataFrame:
        """All samples with the version that added them. Folders of one schema are one scan."""
        groups: dict[str, list[Entry]] = {}
        for e in entries:
            groups.setdefault(e.schema, []).append(e)
        parts = []
        for schema, own in groups.items():
            kind = T.StructType.fromJson(json.loads(schema))
            parts.append(self.spark.read.schema(kind).parquet(*[f"{self.path}/{e.folder}" for e in own]))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _merged(self, df: DataFrame, id_col: str, changes: list[Entry]) -> DataFrame:
        """The samples with the latest value of every changed field: one aggregation of the
        change rows and one join by id."""
        types = {e.field: T.StructType.fromJson(json.loads(e.type))["value"].dataType for e in changes}
        reset = {e.field: e.version for e in changes if e.reset}
        kind = T.StructType([T.StructField(_ID, df.schema[id_col].dataType), T.StructField(_VERSION, T.LongType())])
        for name, dtype in types.items():
            kind = kind.add(_set(name), T.StructType([T.StructField("value", dtype)]))
        rows = self.spark.read.schema(kind).parquet(*[f"{self.path}/{e.folder}" for e in changes if e.rows])
        latest = []
        for name in types:
            value = F.col(quoted(_set(name)))
            counts = value.isNotNull() & (F.col(_VERSION) >= reset.get(name, 0))
            latest.append(F.max_by(value, F.when(counts, F.col(_VERSION))).alias(_set(name)))
        df = df.join(rows.groupBy(_ID).agg(*latest), F.col(quoted(id_col)) == F.col(_ID), "left")
        for name, dtype in types.items():
            top = name.split(".")[0]
            new = F.col(quoted(_set(name)))
            old = F.col(quoted_path(name)) if top in df.columns else F.lit(None).cast(dtype)
            if name in reset:  # what came after the reset keeps its own value
                old = F.when(F.col(_ADDED) > reset[name], old)
            df = with_path(df, name, F.when(new.isNotNull(), new["value"]).otherwise(old))
        return df.drop(_ID, *[_set(name) for name in types])

    # -- writing ---------------------------------------------------------------------

    def _log(self, log: list[Entry], kind: str, folder: str, n: int, rows: int, **about) -> int:
        """Make the next version visible. Two writers of one version: the second raises."""
        version = log[-1].version + 1 if log else 0
        entry = {"batch": None, "field": None, "type": None, "reset": False, "schema": None, **about}
        row = (version, kind, folder, entry["batch"], entry["field"], entry["type"], entry["reset"], n, rows, entry["schema"])
        self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("errorifexists").json(f"{self.path}/log/{version:012d}")
        return n

    def _write_samples(self, log: list[Entry], df: DataFrame, kind: str, batch: str | None) -> int:
        version = log[-1].version + 1 if log else 0
        folder, seen = f"samples-{uuid.uuid4().hex}", Observation()
        own = F.col(_BATCH) if kind == "compact" and _BATCH in df.columns else F.lit(batch).cast("string")
        df = df.withColumn(_ADDED, F.lit(version).cast("long")).withColumn(_BATCH, own)
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{folder}")
        schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])
        return self._log(log, kind, folder, seen.get["n"], seen.get["n"], batch=batch, schema=schema.json())

    def _write_change(self, log: list[Entry], field: str, rows: DataFrame, counted: Column, kept: Column, reset: bool = False) -> int:
        """``rows`` has _id, value; those with ``kept`` are written, those with ``counted``
        are the count."""
        version, folder, seen = log[-1].version + 1, f"change-{uuid.uuid4().hex}", Observation()
        rows = rows.observe(seen, F.count_if(counted).alias("n"), F.count_if(kept).alias("rows")).filter(kept)
        value = F.struct(F.col("value")).alias(_set(field))
        rows.select(_ID, F.lit(version).cast("long").alias(_VERSION), value).write.parquet(f"{self.path}/{folder}")
        kind = T.StructType([T.StructField("value", rows.schema["value"].dataType)]).json()
        return self._log(log, "change", folder, seen.get["n"], seen.get["rows"], field=field, type=kind, reset=reset)

    def add_samples(self, samples: Sequence[Mapping] | DataFrame, batch: str) -> int:
        """Append a batch, as :func:`samplecraft.add_samples` does; only its rows are
        written. A batch key that is there already, compacted or not, is replaced, so that
        a retry gives one copy; changes of its samples since the last compaction stay,
        since their ids are the same."""
        log = self.entries()
        before = self._read(log, without=batch)
        change = mutations.add_samples(before, samples, batch)
        added = change.flagged.df.filter(mutations._TOUCHED).drop(mutations._TOUCHED)
        return self._write_samples(log, added, "samples", batch)

    def _write_tags(self, log: list[Entry], change: mutations.Change, ds: Dataset) -> int:
        flagged = change.flagged.df
        old = F.col("_before") if "tags" in ds.df.columns else F.lit(None).cast("array<string>")
        rows = flagged.select(F.col(quoted(ds.id_col)).alias(_ID), F.col("tags").alias("value"), old.alias("old"), mutations._TOUCHED)
        touched = F.col(mutations._TOUCHED)
        # Samples that have the result already are counted and not written.
        return self._write_change(log, "tags", rows, touched, touched & ~F.col("value").eqNullSafe(F.col("old")))

    def tag_samples(self, tags: str | Sequence[str], view=None, sample_ids=None) -> int:
        """As :func:`samplecraft.tag_samples`; writes the selected samples whose tags
        change. ``view`` is stage specs, or a function from the dataset to a view."""
        return self._tagged(mutations.tag_samples, tags, view, sample_ids)

    def untag_samples(self, tags: str | Sequence[str], view=None, sample_ids=None) -> int:
        """As :func:`samplecraft.untag_samples`, otherwise as :meth:`tag_samples`."""
        return self._tagged(mutations.untag_samples, tags, view, sample_ids)

    def _tagged(self, change, tags, view, sample_ids) -> int:
        log = self.entries()
        ds = self._read(log)
        if "tags" in ds.df.columns:
            ds = ds.with_df(ds.df.withColumn("_before", F.col("tags")))
        return self._write_tags(log, change(ds, tags, view(ds) if callable(view) else view, sample_ids), ds)

    def set_values(self, field: str, values: Mapping | Sequence | DataFrame, key_field: str | None = None, keep_unmatched: bool = False) -> int:
        """As :func:`samplecraft.set_values`; writes the samples that are given a value.
        That all others become null is one mark in the log."""
        log = self.entries()
        ds = self._read(log)
        change = mutations.set_values(ds, field, values, key_field, keep_unmatched)
        dtype = field_type(change.flagged.df.schema, field)
        ident = F.col(quoted(ds.id_col)).alias(_ID)
        keyed = isinstance(values, (Mapping, DataFrame))
        if not keyed:
            rows = change.flagged.df.select(ident, F.col(quoted_path(field)).alias("value"))
            return self._write_change(log, field, rows, F.lit(True), F.lit(True))
        # Only samples that have a value: an inner join instead of the left one.
        table = mutations.keyed_values(ds, values, key_field or ds.id_col)
        found = ds.df.join(table, F.col(quoted_path(key_field or ds.id_col)) == F.col("_key"))
        rows = found.select(ident, F.col("_value").cast(dtype).alias("value"), F.col("_value").isNotNull().alias("given"))
        return self._write_change(log, field, rows, F.col("given"), F.col("given") | F.lit(keep_unmatched), reset=not keep_unmatched)

    def compact(self) -> int:
        """Write the latest version as new samples; returns their number. Earlier versions
        can still be read, later ones start from here."""
        log = self.entries()
        return self._write_samples(log, self._read(log).stamped(), "compact", None)


def create_store(ds: Dataset, path: str) -> Store:
    """Write a dataset as version 0 of a new store; the folder must be new."""
    store = Store(ds.spark, path.rstrip("/"))
    try:
        store.entries()
    except AnalysisException:
        store._write_samples([], ds.stamped(), "compact", None)
        return store
    raise ValueError(f"there is a store at '{path}' already")


def open_store(spark: SparkSession, path: str) -> Store:
    """An existing store; a folder without one is an error."""
    store = Store(spark, path.rstrip("/"))
    try:
        store.entries()
    except AnalysisException:
        raise ValueError(f"no store at '{path}'") from None
    return store
