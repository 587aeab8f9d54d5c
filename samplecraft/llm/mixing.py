"""Mixing sources to target weights, each source to its exact budget.

A source's target is its share of the mix by weight, but not more than ``most`` times its
size: what is above goes to the others by their weights, until none is above. So there is a
level with ``target = min(most * size, weight * level)``.

Documents are put in a random order by a hash of the document, range-sorted inside each
source, and get the sum of the sizes before them: sums run through the sorted partitions in
their tasks, and a row for each partition carries them on. A source's budget is as many
whole epochs as fit, and of one more epoch the documents whose sums are below what is
left; the document across the cut is taken up to it. Hashes make reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..plans.ranking import ranked
from ..plans.staging import staged
from . import words as W

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)  # of all sizes, what the mix has
MOST = 2  # times its size, what the mix has of a source


def word_count(texts: Column) -> Column:
    """The longest runs of bytes other than ASCII white space; 0 for null."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        data, bounds = W.text_bytes(texts)
        parts = [np.zeros(0, np.int64)]
        for i, j in W.slices(bounds):
            at = bounds[i : j + 1] - bounds[i]
            starts, _ = W.word_spans(data[bounds[i] : bounds[j]], at)
            parts.append(np.diff(np.searchsorted(starts, at)))
        return pa.array(np.concatenate(parts), pa.int64())

    return count(texts)


def targets(sources: DataFrame, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to (source_size, weight) rows of sources; ``most`` >= ``share``.

    Each round fixes the sources that their weight would put above their most, which only
    get more, and the level of the others rises; three sums of each round reach the driver.
    """
    cap = F.col("source_size") * most
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    whole = share * total
    level, fixed = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level) if fixed >= 0 else F.lit(False)
        row = sources.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if row["n"] == fixed or not row["weights"]:
            break
        fixed, level = row["n"], float(whole - row["held"]) / row["weights"]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return sources.withColumn("target", target if fixed >= 0 else cap.cast("double"))


def weighted(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Adds ``weight``: the weights in turn to the sources by code point, null last."""
    placed = ranked(sources.withColumn("last", F.col("source").isNull()), [F.col("last"), F.col("source")]).drop("last")
    turn = F.pmod("position", F.lit(len(weights))).cast("int")
    return placed.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1)).drop("position")


def _summed(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows with ``before``, the sum of ``size`` over all rows before them in an order of
    theirs. One range shuffle and one write; each task adds up its partition."""
    names = rows.columns

    def run(batches):
        so_far = 0
        for batch in batches:
            sums = so_far + np.cumsum(batch.column("size").to_numpy(), dtype=np.int64)
            if len(sums):
                before = np.concatenate([[so_far], sums[:-1]])
                so_far = int(sums[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "inside"])

    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("inside", T.LongType())])
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of the partition is taken in Spark, below the Python node.
    placed = sorted_rows.withColumn("part", F.spark_partition_id()).mapInArrow(run, schema)
    table = staged(placed, "running-sums")
    # A row for each partition, whatever the data: a bounded window and broadcast.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = table.groupBy("part").agg(F.sum("size").alias("sum")).select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("earlier"))
    return table.join(F.broadcast(parts), "part").select(*names, (F.col("earlier") + F.col("inside")).alias("before"))


def plan_mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    seed: int = 0,
) -> DataFrame:
    """One row for each document: ``key``, source, size, source_size, target (of its
    source), taken (what the mix has of it, repeats counted).

    ``size`` is a column of non-negative whole numbers, null as 0; without one it is the
    number of words of ``text``, 0 for null. A source's ``taken`` sum to its target,
    rounded down; a source of size 0 has target 0. A null source is a source, the last one. A
    document is taken at most ``most`` times its size. The order of draws hashes seed,
    key and text; repeated rows are documents of their own, and which of them is cut is
    open. Columns that are not named are ignored, whatever their names.
    """
    if most < share:
        raise ValueError("the sources together can't fill the mix: most is below share")
    given = word_count(F.col(f"`{text}`")) if size is None else F.coalesce(size.cast("long"), F.lit(0))
    doc_key, own_text = F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_key.cast("string"), F.lit("-")), F.md5(own_text.cast("binary"))).cast("binary"))
    rows = docs.select(doc_key.alias("key"), F.col(f"`{source}`").cast("string").alias("source"), given.alias("size"), draw.alias("draw"))
    rows = staged(rows, "mix-sizes")  # texts are read once
    sources = weighted(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    sources = targets(staged(sources, "mix-sources"), share, most)
    summed = _summed(rows, [F.col("source"), F.col("draw"), F.col("key")])
    starts = summed.groupBy(F.col("source").alias("of")).agg(F.min("before").alias("start"))
    # Written, so that their size tells Spark whether they may be broadcast.
    plan = staged(sources.join(starts, F.col("source").eqNullSafe(F.col("of"))).select("of", "source_size", "target", "start"), "mix-targets")
    found = summed.join(plan, F.col("source").eqNullSafe(F.col("of")))
    budget = F.floor("target").cast("long")
    epochs = F.coalesce(F.expr("cast(floor(target) as long) div nullif(source_size, 0)"), F.lit(0))
    left = budget - epochs * F.col("source_size") - (F.col("before") - F.col("start"))
    part = F.greatest(F.lit(0).cast("long"), F.least(left, F.col("size")))
    taken = epochs * F.col("size") + part
    return found.select(F.col("key").alias(key), "source", "size", "source_size", "target", taken.alias("taken"))


def draws(plan: DataFrame) -> DataFrame:
    """The mix itself: the rows of a plan once for each time that a document is drawn, with
    ``epoch`` (from 0) and ``words`` (its first ones that are used)."""
    size, taken = F.col("size"), F.col("taken")
    times = F.when(taken > 0, F.ceil(taken / size)).otherwise(0).cast("int")
    repeated = plan.filter(taken > 0).select("*", F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch"))
    return repeated.withColumn("words", F.least(size, taken - F.col("epoch") * size))
