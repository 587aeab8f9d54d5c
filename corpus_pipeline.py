"""A training corpus from raw documents, in five stages.

Each stage is a function of ``(spark, docs, sf_dir)``. What it returns is written as
Parquet to the cluster's shared folder and read again as the next stage's documents.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samplecraft.llm import decontaminate, line_dedup, ngram_join, packing, quality
from samplecraft.plans.staging import set_local_folder, staged

GOOD = 0.5  # a document stays with this probability of quality or more ...
TOXIC = 0.5  # ... and less than this of being toxic


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers find good and not toxic.

    Columns stay as they are; without labels every document stays.
    """
    set_local_folder(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    metadata = tuple(c for c in ("lang", "source", "n_chars") if c in docs.columns)
    model = quality.train(docs, labels, ("quality", "toxic"), metadata=metadata)
    suffix = "_score"
    while any(f"{t}{suffix}" in docs.columns for t in model.targets):
        suffix += "_"
    scored = quality.score(docs, model, suffix=suffix)
    toxic = F.col(f"toxic{suffix}") if model.targets["toxic"].trained else F.lit(0.0)
    return scored.filter((F.col(f"quality{suffix}") >= GOOD) & (toxic < TOXIC)).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without line runs of 50 words or more that occur before. A document of
    which nothing is left goes; n_chars follows the text."""
    set_local_folder(spark)
    left = line_dedup.dedup_lines(docs, drop_emptied=True)
    if "n_chars" not in docs.columns:
        return left
    kind = docs.schema["n_chars"].dataType
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind))
    return left.select(*[size.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones."""
    set_local_folder(spark)
    return ngram_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't overlap with a benchmark item."""
    set_local_folder(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Training a classifier, hashing signatures and a tokenizer are not SQL's: the tests hold
#: the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_local_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
