"""Curation datasets on the star-schema test tables.

The raw tables have no nested labels, tags or groups; these functions derive them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dataset import Dataset


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _label(line: Column) -> Column:
    """A line item as a label."""
    return F.struct(
        F.concat_ws(
            "-", line["l_orderkey"], line["l_linenumber"], line["l_partkey"], line["l_suppkey"]
        ).alias("id"),
        line["l_returnflag"].alias("label"),
        (line["l_quantity"] / 50.0).alias("confidence"),
        F.array(line["l_linestatus"]).alias("tags"),
        # + 0.0 turns the -0.0 found in the data into 0.0
        F.array(
            line["l_discount"] * 5 + 0.0, line["l_tax"] * 6.25, F.lit(0.5), F.lit(0.5)
        ).alias("box"),
    )


# The first three columns give a label its place in the list.
_LINE = (
    "l_linenumber l_partkey l_suppkey l_orderkey l_returnflag l_quantity l_linestatus "
    "l_discount l_tax"
).split()


def samples(spark: SparkSession, folder: str) -> Dataset:
    """Orders as samples, their line items as labels.

    A sample is one record and owns its label list, like any document with embedded
    labels. Collecting a list cannot be combined before the shuffle, so the raw columns
    are shuffled as they are and become labels afterwards; the join then reuses their
    partitioning.
    """
    lines = table(spark, folder, "lineitem").repartition("l_orderkey")
    nested = lines.groupBy("l_orderkey").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(*_LINE))), _label).alias("detections")
    )
    # The size of collected lists is underestimated, and they are no side to broadcast.
    joined = table(spark, folder, "orders").join(
        nested.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    empty = F.array().cast(nested.schema["detections"].dataType)
    df = joined.select(
        F.col("o_orderkey").cast("string").alias("sample_id"),
        F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("order/"), "o_orderkey").alias("filepath"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.col("o_totalprice").alias("score"),
        F.col("o_orderdate").alias("created_at"),
        F.coalesce("detections", empty).alias("detections"),
    )
    return Dataset(df, order=("ord",), name="samples", media_type="image")


def docs(spark: SparkSession, folder: str) -> Dataset:
    """Documents as samples, with the quality labels that some of them have."""
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    df = documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("sample_id"),
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("doc/"), "doc_id").alias("filepath"),
        F.array("lang", "source").alias("tags"),
        "lang",
        "source",
        "n_chars",
        "quality",
        "toxic",
    )
    return Dataset(df, order=("ord",), name="docs", media_type="text")


def vecs(spark: SparkSession, folder: str) -> Dataset:
    """Embeddings, one per sample."""
    return Dataset(table(spark, folder, "embeddings"), id_col="vec_id", name="vecs")


def turns(spark: SparkSession, folder: str) -> Dataset:
    """Conversations as groups, the roles as slices."""
    df = table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("sample_id"),
        F.col("conv_id").alias("group_id"),
        F.col("role").alias("slice"),
        F.lit("text").alias("media_type"),
        "turn",
        "text",
    )
    return Dataset(df, order=("group_id", "turn"), name="turns", media_type="group")


def events(spark: SparkSession, folder: str) -> Dataset:
    """The event log as a flat dataset."""
    return Dataset(table(spark, folder, "events"), id_col="event_id", name="events")
