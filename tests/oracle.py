"""Running a registered query in Spark and its SQL in DuckDB, and comparing the two."""

from __future__ import annotations

import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(folder)):
        if file.endswith(".parquet"):
            name = file.removesuffix(".parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


# Spark type -> the DuckDB types that hold the same values
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
}


def differences(df, con, sql: str) -> str | None:
    """None if the query's rows are the SQL's rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = _rows(names, result.fetchall())
    ours = _rows(df.columns, df.collect())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    for f in df.schema.fields:
        if types[f.name] not in SAME_TYPE.get(f.dataType.simpleString(), ()):
            return f"column {f.name}: {f.dataType.simpleString()} and {types[f.name]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} and {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            return f"{a} and {b}"
    return None
