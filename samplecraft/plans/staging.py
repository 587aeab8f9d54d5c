"""Intermediate tables written to the cluster's shared folder.

Some plans need one result twice and it has to be the same both times (a range
partitioning, a cell assignment). Writing it to shared storage cuts the lineage
there, and a lost executor then costs a re-read, not a recomputation.

All tables of a Spark application lie in one folder below the shared one, and
``remove_staged`` deletes that folder when no result is read any more.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; without one it raises."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return folder.rstrip("/")


def set_local_folder(spark: SparkSession) -> SparkSession:
    """For entry points, tests and benchmarks: give a local session that names no shared
    folder one of its own. On a cluster nothing is set, since a machine's own folder is
    not visible to the other machines."""
    master = spark.sparkContext.master
    if not spark.conf.get(CHECKPOINT_DIR, None) and (master == "local" or master.startswith("local[")):
        spark.conf.set(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="samplecraft-"))
    return spark


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/samplecraft/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **options) -> str:
    """Write ``df`` to a new path of the shared folder and return the path."""
    path = new_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return path


def staged(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of what was written."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, label, **options))


def remove_staged(spark: SparkSession) -> bool:
    """Delete all tables this application has staged; results that read them, and lazy
    DataFrames built on them, can't be used afterwards. True if there were any."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
