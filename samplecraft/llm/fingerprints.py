"""MinHash fingerprints of documents, and near duplicates found with them.

A fingerprint holds, for each of ``PERMUTATIONS`` universal hash functions, 16 bits of
the smallest hash of the text's shingles (runs of five words). The share of equal
values estimates the Jaccard similarity of two texts. Texts with an equal band of values
meet in a Spark join (see ``similar``) and are then compared exactly.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import staged
from . import similar
from . import words as W
from .ranges import LEAST_KEY, bucket_of, key_splits

THRESHOLD = 0.8
BUCKET = 8192  # documents that stand together when each is shown its next one


def signed_texts(texts: pa.Array) -> np.ndarray:
    parts = [similar.signed(shingles, bounds) for _, _, shingles, bounds in W.text_shingles(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, similar.PERMUTATIONS), "<u2")


def printed(signature: np.ndarray) -> str:
    return base64.b64encode(signature.tobytes()).decode()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_chars (code points) and fingerprint of every document. A null text is
    an empty one; repeated rows are documents of their own."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            signatures = signed_texts(batch.column("text"))
            size = [len(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(size, pa.int64()), pa.array([printed(s) for s in signatures], pa.string())],
                ["key", "n_chars", "fingerprint"],
            )

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_chars long, fingerprint string").withColumnRenamed("key", key)


@F.pandas_udf(T.DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal values of two fingerprints; null if one is null."""

    def one(x, y):
        if x is None or y is None:
            return None
        x, y = (np.frombuffer(base64.b64decode(v), "<u2") for v in (x, y))
        return float((x == y).mean())

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, shingle: int = W.SHINGLE) -> DataFrame:
    """One row for each document: ``key``, class_id (the smallest key among those that
    near duplicates connect), n_links (near duplicates of the document itself).

    Documents with an equal band are candidates, their Jaccard similarity is verified on
    the whole texts. Texts without words are near to nothing.
    """
    features = staged(similar.featured(docs, key, text, shingle), "signatures")
    nodes = similar.noded(features)
    rows = staged(similar.blocked(*similar.celled(nodes)), "blocks")
    found = similar.linked(similar.with_texts(rows, docs, features, nodes, key, text, shingle), threshold, shingle)
    return similar.classed(features, nodes, found, key)


def with_next(docs: DataFrame, key: str, text: str, run, schema: str) -> DataFrame:
    """Apply ``run(keys, texts)`` to documents in descending order of their key, cyclic:
    the lists have the documents and one more, the next of the last of them.

    Documents are dealt to ranges of keys, and each range is given the first document
    of the next one, so a text is moved once. Documents of the same key stand in the
    order of their texts; a null key is the smallest.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    order = F.coalesce("key", F.lit(LEAST_KEY))
    splits = key_splits(rows.select(order.alias("k")), "k", BUCKET)
    rows = rows.withColumn("order", order).withColumn("bucket", bucket_of(splits)(order))
    # One row for each range, whose number ``key_splits`` bounds.
    firsts = {r.bucket: r.k for r in rows.groupBy("bucket").agg(F.max("order").alias("k")).collect()}
    held = sorted(firsts, reverse=True)
    # The first document of a range goes to the range before it, that of the first to the last.
    before = [(firsts[b], held[i - 1]) for i, b in enumerate(held)]
    extra = docs.sparkSession.createDataFrame(before, "order long, goes int")
    extra = rows.join(F.broadcast(extra), "order").groupBy("order", "goes").agg(F.min(F.struct("text", "key")).alias("f"))
    extra = extra.select("f.key", "f.text", "order", F.col("goes").alias("bucket"), F.lit(1).alias("extra"))
    both = rows.withColumn("extra", F.lit(0)).unionByName(extra)

    def each(batches):
        held_back = []  # the last row seen: its next one has not come yet

        for batch in batches:
            sizes = W.text_bytes(batch.column("text"))[1]
            for i, j in W.slices(sizes):
                part = batch.slice(i, j - i).to_pylist()
                group = held_back + part
                held_back = group[-1:]
                start = 0
                for n in range(len(group) - 1):
                    if group[n]["extra"]:  # no document of this range any more
                        if n > start:
                            yield from run([g["key"] for g in group[start : n + 1]], [g["text"] for g in group[start : n + 1]])
                        start = n + 1
                if len(group) - 1 > start:
                    yield from run([g["key"] for g in group[start:]], [g["text"] for g in group[start:]])

    return (
        both.repartitionById(len(splits) + 1, "bucket")
        .sortWithinPartitions("bucket", "extra", F.col("order").desc(), "text")
        .select("key", "text", "extra")
        .mapInArrow(each, schema)
    )


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document next to an edited one and to the next one in descending key order.

    The edited text has its last floor(n / 2) code points replaced by the first as many
    (or all) of the next document's. Columns: ``key``, n_chars, edited_sha256 (of its
    UTF-8), fingerprint, edited_fingerprint, near_edited and near_next (likeness of the
    fingerprint to the edited text's and to the next document's). A null text is an
    empty one, and two empty texts are alike; an only document is its own next one.
    """

    def run(keys, texts):
        n = len(texts) - 1
        edited = [t[: len(t) - len(t) // 2] + follow[: len(t) // 2] for t, follow in zip(texts, texts[1:])]
        own, other = signed_texts(pa.array(texts, pa.large_string())), signed_texts(pa.array(edited, pa.large_string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[:n], pa.int64()),
                pa.array([len(t) for t in texts[:n]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([printed(s) for s in own[:n]], pa.string()),
                pa.array([printed(s) for s in other], pa.string()),
                pa.array((own[:n] == other).mean(axis=1)),
                pa.array((own[:n] == own[1:]).mean(axis=1)),
            ],
            names,
        )

    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, key, text, run, schema).withColumnRenamed("key", key)
