"""Similarity: sorting by nearness, nearest neighbours, near duplicates, uniqueness."""

from __future__ import annotations

import numbers as numbers_abc

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..dataset import ORDER, Dataset, field_type, quoted, quoted_path
from ..functions import vectors as V
from ..plans import vector_cells
from ..plans.vector_cells import DIGEST
from ..plans.staging import staged
from ..sources.similarity_index import SimilarityIndex
from .ordering import limit
from .samples import select


def _is_vector(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(
        dtype.elementType, (T.FloatType, T.DoubleType)
    )


def embedding_field(ds: Dataset, brain_key: str | None = None) -> str:
    """The embedding column: the one named, or the only list of floats there is."""
    if brain_key is not None:
        if not _is_vector(field_type(ds.df.schema, brain_key)):
            raise ValueError(f"'{brain_key}' does not hold vectors")
        return brain_key
    found = [f.name for f in ds.df.schema.fields if _is_vector(f.dataType)]
    if len(found) != 1:
        raise ValueError(f"name the embedding field, found {len(found)}")
    return found[0]


def _mean_vector(rows: DataFrame, vec: str) -> list[float]:
    """The mean of a vector column: one average per dimension, and just these are
    brought to the driver."""
    places = rows.select(F.posexplode(V.as_doubles(F.col(quoted_path(vec)))).alias("i", "x"))
    means = places.groupBy("i").agg(F.avg("x").alias("x")).orderBy("i").collect()
    if not means:
        raise ValueError("no sample with a vector among the query ids")
    return [row["x"] for row in means]


def _query_vector(ds: Dataset, query, vector, vec: str) -> list[float]:
    if (query is None) == (vector is None):
        raise ValueError("give either a query or a vector")
    if vector is None and not isinstance(query, (str, DataFrame)):
        values = [query] if np.ndim(query) == 0 else list(query)
        numbers = bool(values) and all(isinstance(x, numbers_abc.Real) and not isinstance(x, bool) for x in values)
        counted = isinstance(ds.df.schema[ds.id_col].dataType, T.NumericType)
        fractions = any(not isinstance(x, numbers_abc.Integral) for x in values)
        if np.ndim(query) and numbers and (fractions or not counted):
            vector = values
        else:
            query = values
    if vector is not None:
        return [float(x) for x in vector]
    return _mean_vector(select(ds, query).df, vec)


def sort_by_similarity(
    ds: Dataset,
    query=None,
    k: int | None = None,
    brain_key: str | None = None,
    metric: str = "cosine",
    dist_field: str | None = None,
    vector=None,
    index: SimilarityIndex | None = None,
) -> Dataset:
    """Order by nearness to ``query``; ``k`` keeps the nearest k.

    ``query`` is an id, ids, a DataFrame of ids, or a vector; several ids stand for the
    mean of their vectors. ``vector`` is always a vector. A list or array of numbers is a
    vector if it has a fraction type or the dataset's ids are not numbers; whole numbers
    are ids where ids are numbers [chosen]. ``brain_key`` names the embedding column and
    ``dist_field`` a field for the distances. Samples without a vector are left out
    [chosen]; a vector of another length, and for the cosine metric a query of length
    zero, raises. Text queries need a model and are not supported.

    With a stored ``index`` and ``k``, only the vectors of its cells near the query are
    read; field and metric are the index's, as are the vectors, so samples that have come
    since it was built are left out [chosen]. The result is the nearest k of ``ds``, also
    if that is a view of what was indexed.
    """
    if index is not None:
        if k is None:
            raise ValueError("a search in an index needs k")
        return _by_index(ds, query, vector, k, index, dist_field)
    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {', '.join(V.METRICS)}")
    vec = embedding_field(ds, brain_key)
    apart = V.distance_to(F.col(quoted_path(vec)), _query_vector(ds, query, vector, vec), metric)
    df = ds.df.drop(ORDER).withColumn(ORDER, apart)
    df = df.filter(F.col(ORDER).isNotNull() & ~F.isnan(ORDER))
    if dist_field is not None:
        df = df.withColumn(dist_field, F.col(ORDER))
    view = ds.with_df(df, order=(ORDER,), reverse=False)
    return view if k is None else limit(view, k)


def _by_index(ds: Dataset, query, vector, k: int, index: SimilarityIndex, dist_field: str | None) -> Dataset:
    if index.id_col != ds.id_col:
        raise ValueError(f"the index is of ids in '{index.id_col}', the dataset's are in '{ds.id_col}'")
    id_col = F.col(quoted(ds.id_col))
    # A query id need not be in the view.
    asked = _query_vector(Dataset(index.members, id_col="id"), query, vector, "vec")
    near = index.nearest(asked, k, ds.df.select(id_col))
    near = near.select(F.col("id").alias(ds.id_col), F.col("distance").alias(ORDER))
    df = ds.df.drop(ORDER).join(near, ds.id_col)
    if dist_field is not None:
        df = df.withColumn(dist_field, F.col(ORDER))
    return ds.with_df(df, order=(ORDER,), reverse=False)


def knn_join(
    queries: Dataset,
    base: Dataset,
    k: int,
    brain_key: str | None = None,
    metric: str = "cosine",
    exclude_self: bool = False,
    cell_rows: int | None = None,
) -> DataFrame:
    """``query_id, rank, neighbour_id, distance``: the k nearest base samples of every
    query sample, exactly; ties go to the smaller id.

    ``exclude_self`` leaves out the base sample with the query's id. Samples on either
    side whose vector is null, has a missing number or, for the cosine metric, has
    length zero are left out.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if metric not in V.METRICS:
        raise ValueError(f"metric must be one of {', '.join(V.METRICS)}")
    unit = metric == "cosine"
    same = queries is base
    need = k + 1 if exclude_self else k
    base_rows = vector_cells.comparable(base.df, base.id_col, embedding_field(base, brain_key), unit)
    asked = base_rows if same else vector_cells.comparable(
        queries.df, queries.id_col, embedding_field(queries, brain_key), unit
    )
    members = vector_cells.collapse(base_rows, ids=need)
    cells = vector_cells.build_cells(members, unit, cell_rows)
    id_type = base_rows.schema["id"].dataType
    if cells is None:
        schema = T.StructType(
            [
                T.StructField("query_id", asked.schema["id"].dataType),
                T.StructField("rank", T.IntegerType()),
                T.StructField("neighbour_id", id_type),
                T.StructField("distance", T.DoubleType()),
            ]
        )
        return base.spark.createDataFrame([], schema)
    vectors = members if same else vector_cells.collapse(asked)
    found = vector_cells.nearest(cells, vectors, need, same)
    one = F.transform("ids", lambda i: F.struct(F.col("gap").alias("gap"), i.alias("id")))
    # At most ``need`` vectors with at most ``need`` ids each: a small list per vector.
    lists = found.groupBy("key").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list(one))), 1, need).alias("near")
    )
    per_vector = vectors.select("key", *DIGEST).join(lists, "key").drop("key")
    # One row per digest on this side: adaptive execution splits a vector with many ids.
    answers = asked.select("id", *DIGEST).join(per_vector, DIGEST)
    near = F.col("near")
    if exclude_self:
        near = F.filter(near, lambda n: n["id"] != F.col("id"))
    apart = F.col("n.gap") if unit else F.sqrt("n.gap")
    return answers.select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(near, 1, k)).alias("place", "n")
    ).select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("n.id").alias("neighbour_id"),
        apart.alias("distance"),
    )


def near_duplicates(
    ds: Dataset,
    threshold: float,
    brain_key: str | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """``id_a, id_b, cosine, n_near``: samples ``id_b`` that are near duplicates of an
    earlier one.

    ``id_a < id_b`` is the smallest id within the cosine threshold, ``cosine`` the
    similarity of the two, and ``n_near`` how many other samples are within the
    threshold of ``id_b``. All pairs are compared (exactly, up to what the triangle
    inequality rules out), but a group of m copies gives m - 1 rows and not m squared
    pairs [chosen]. For thresholds in (0, 1]. Samples whose vector is null, has a
    missing number or has length zero are left out. A cosine of up to 1e-9 less than the
    threshold counts, so that parallel vectors are found at 1.
    """
    if not 0.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (0, 1]")
    rows = vector_cells.comparable(ds.df, ds.id_col, embedding_field(ds, brain_key), True)
    members = vector_cells.collapse(rows)
    cells = vector_cells.build_cells(members, True, cell_rows)
    id_type = rows.schema["id"].dataType
    if cells is None:
        schema = T.StructType(
            [
                T.StructField("id_a", id_type),
                T.StructField("id_b", id_type),
                T.StructField("cosine", T.DoubleType()),
                T.StructField("n_near", T.LongType()),
            ]
        )
        return ds.spark.createDataFrame([], schema)
    counts = vector_cells.neighbour_counts(cells, threshold).filter(F.col("total") > 1)
    per_vector = members.select("key", *DIGEST).join(counts, "key").drop("key")
    return (
        rows.select("id", *DIGEST)
        .join(per_vector, DIGEST)
        .filter(F.col("first") < F.col("id"))
        .select(
            F.col("first").alias("id_a"),
            F.col("id").alias("id_b"),
            "cosine",
            (F.col("total") - 1).alias("n_near"),
        )
    )


def uniqueness(
    ds: Dataset,
    k: int = 5,
    brain_key: str | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """``id, uniqueness``: the mean cosine distance to the k nearest other samples,
    divided by the largest such mean, so the most isolated sample has 1 [chosen].

    A sample without any other sample to compare with has 1; samples whose vector is
    null, has a missing number or has length zero are left out.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = vector_cells.comparable(ds.df, ds.id_col, embedding_field(ds, brain_key), True)
    members = vector_cells.collapse(rows)
    cells = vector_cells.build_cells(members, True, cell_rows)
    if cells is None:
        schema = T.StructType(
            [rows.schema["id"], T.StructField("uniqueness", T.DoubleType())]
        )
        return ds.spark.createDataFrame([], schema)
    found = vector_cells.nearest(cells, members, k + 1, same=True)
    # One distinct vector stands for all its copies; a sample is no neighbour of itself.
    others = F.col("copies") - F.when(F.col("neighbour") == F.col("key"), 1).otherwise(0)
    nearer = Window.partitionBy("key").orderBy("gap", "neighbour")
    before = nearer.rowsBetween(Window.unboundedPreceding, -1)
    weighted = (
        found.withColumn("others", others)
        .withColumn("seen", F.coalesce(F.sum("others").over(before), F.lit(0)))
        .withColumn("used", F.greatest(F.least("others", F.lit(k) - F.col("seen")), F.lit(0)))
    )
    apart = F.sum(F.col("used") * F.greatest("gap", F.lit(0.0)))
    means = weighted.groupBy("key").agg(
        (apart / F.nullif(F.sum("used"), F.lit(0))).alias("mean")
    )
    means = staged(means, "means")
    per_vector = members.select("key", *DIGEST).join(means, "key").drop("key")
    largest = means.agg(F.max("mean")).scalar()
    scaled = F.when(F.col("mean").isNull(), 1.0).when(largest == 0, 0.0)
    return rows.select("id", *DIGEST).join(per_vector, DIGEST).select(
        "id", scaled.otherwise(F.col("mean") / largest).alias("uniqueness")
    )
