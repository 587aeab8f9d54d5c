from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import samplecraft as sc  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("samplecraft-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="samplecraft-tests-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def dataset(spark, rows, schema, partitions=None, **kwargs):
    df = spark.createDataFrame(rows, schema)
    if partitions:
        df = df.repartition(partitions)
    return sc.Dataset(df, **kwargs)


@pytest.fixture(scope="session")
def ten(spark):
    """Ten samples with a score, a category and a split tag."""
    categories = ["red", "blue", "blue", "green", "red", "blue", "green", "green", "red", "blue"]
    scores = [4.5, 1.0, 7.25, 2.0, 9.5, 3.5, 8.0, 0.5, 6.0, 5.5]
    rows = [
        (f"s{i}", i, f"image_{i}.jpg", ["train" if i < 7 else "test"], scores[i], categories[i])
        for i in range(10)
    ]
    schema = "sample_id string, ord long, filepath string, tags array<string>, score double, category string"
    return dataset(spark, rows, schema, order=("ord",))


LABEL = "struct<id:string,label:string,confidence:double,tags:array<string>>"


@pytest.fixture(scope="session")
def labelled(spark):
    """Label lists with every awkward shape: empty, null, null parts."""
    rows = [
        ("a", "a.jpg", ["x"], [("1", "cat", 0.9, ["ok"]), ("2", "dog", 0.2, ["bad", "ok"])], None),
        ("b", "b.jpg", [], [("3", "cat", None, None)], [("9", "car", 0.7, ["ok"])]),
        ("c", "c.jpg", None, [], []),
        ("d", "d.jpg", ["y", "y"], None, [("8", "bus", 0.4, [])]),
        ("e", "e.jpg", ["x", "y"], [("4", None, 0.5, []), ("5", "dog", float("nan"), ["bad"])], []),
    ]
    schema = (
        f"sample_id string, filepath string, tags array<string>, "
        f"animals array<{LABEL}>, vehicles array<{LABEL}>"
    )
    return dataset(spark, rows, schema)


def ids(ds) -> list:
    """Ids in dataset order."""
    return [r[ds.id_col] for r in ds.sorted_rows().select(ds.id_col).collect()]


def id_set(ds) -> set:
    return {r[0] for r in ds.df.select(ds.id_col).collect()}
