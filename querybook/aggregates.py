"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.sources import curation_tables as ct

from .book import DETECTIONS, DOCS, SAMPLES, query


@query(
    "label_counts_of_tagged",
    """SELECT label AS value, count(*) AS n FROM detections
       WHERE (tag_1 = 'F' OR tag_2 = 'F') AND confidence > 0.5 GROUP BY label""",
    using=(DETECTIONS,),
)
def label_counts_of_tagged(spark, folder):
    """How often each label occurs among confident detections in samples tagged F."""
    view = sc.match_tags(ct.samples(spark, folder), "F")
    view = sc.filter_labels(view, "detections", "l.confidence > 0.5")
    return sc.count_values(view, "detections.label")


@query(
    "count_values",
    "SELECT label AS value, count(*) AS n FROM detections GROUP BY label",
    using=(DETECTIONS,),
)
def count_values(spark, folder):
    return sc.count_values(ct.samples(spark, folder), "detections.label")


@query(
    "count_values_with_null",
    "SELECT quality AS value, count(*) AS n FROM docs WHERE lang = 'en' GROUP BY quality",
    using=(DOCS,),
)
def count_values_with_null(spark, folder):
    return sc.count_values(
        ct.docs(spark, folder), "quality", stages=[{"type": "MatchTags", "tags": "en"}]
    )


@query(
    "count_values_totals",
    "SELECT count(*) AS total, count(DISTINCT label) AS num_values FROM detections",
    using=(DETECTIONS,),
)
def count_values_totals(spark, folder):
    return sc.count_values_totals(ct.samples(spark, folder), "detections.label")


@query("distinct", "SELECT DISTINCT source AS value FROM docs", using=(DOCS,))
def distinct(spark, folder):
    return sc.distinct(ct.docs(spark, folder), "source")


@query(
    "distinct_count",
    "SELECT count(DISTINCT quality) AS count FROM docs",
    using=(DOCS,),
)
def distinct_count(spark, folder):
    return sc.distinct_count(ct.docs(spark, folder), "quality")


@query("bounds", "SELECT min(value) AS min, max(value) AS max FROM events")
def bounds(spark, folder):
    return sc.bounds(ct.events(spark, folder), "value")


@query(
    "bounds_nested",
    "SELECT min(confidence) AS min, max(confidence) AS max FROM detections",
    using=(DETECTIONS,),
)
def bounds_nested(spark, folder):
    return sc.bounds(ct.samples(spark, folder), "detections.confidence")


@query("mean", "SELECT round(avg(value), 6) AS mean FROM events")
def mean(spark, folder):
    return sc.mean(ct.events(spark, folder), "value").select(F.round("mean", 6).alias("mean"))


@query("sum", "SELECT round(sum(value), 4) AS sum FROM events")
def sum(spark, folder):
    return sc.sum(ct.events(spark, folder), "value").select(F.round("sum", 4).alias("sum"))


@query("std", "SELECT round(stddev_pop(value), 6) AS std FROM events")
def std(spark, folder):
    return sc.std(ct.events(spark, folder), "value").select(F.round("std", 6).alias("std"))


@query(
    "std_of_sample",
    "SELECT round(stddev_samp(confidence), 6) AS std FROM detections",
    using=(DETECTIONS,),
)
def std_of_sample(spark, folder):
    spread = sc.std(ct.samples(spark, folder), "detections.confidence", sample=True)
    return spread.select(F.round("std", 6).alias("std"))


def histogram_sql(values: str, lo: str, hi: str, bins: int) -> str:
    return f"""SELECT CAST(b.bin AS INTEGER) AS bin,
              round(lo + (hi - lo) * b.bin / {bins}.0, 6) AS lower,
              round(lo + (hi - lo) * (b.bin + 1) / {bins}.0, 6) AS upper,
              count(v.value) AS n,
              (SELECT count(*) FROM ({values}) WHERE value IS NULL OR value < e.lo OR value > e.hi)
                AS other
       FROM (SELECT {lo} AS lo, {hi} AS hi FROM ({values})) e
       CROSS JOIN range({bins}) b(bin)
       LEFT JOIN ({values}) v ON v.value BETWEEN e.lo AND e.hi
        AND least(floor((v.value - e.lo) / (e.hi - e.lo) * {bins}), {bins - 1}) = b.bin
       GROUP BY b.bin, lo, hi"""


def rounded_edges(df):
    return df.select(
        "bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n", "other"
    )


@query(
    "histogram_values",
    histogram_sql("SELECT value FROM events", "min(value)", "max(value)", 50),
)
def histogram_values(spark, folder):
    return rounded_edges(sc.histogram_values(ct.events(spark, folder), "value"))


@query(
    "histogram_values_in_range",
    histogram_sql(
        "SELECT CAST(confidence AS DOUBLE) AS value FROM detections",
        "any_value(0.25)::DOUBLE",
        "any_value(0.75)::DOUBLE",
        7,
    ),
    using=(DETECTIONS,),
)
def histogram_values_in_range(spark, folder):
    return rounded_edges(
        sc.histogram_values(
            ct.samples(spark, folder), "detections.confidence", bins=7, value_range=[0.25, 0.75]
        )
    )


@query(
    "get_values",
    """SELECT row_number() OVER (ORDER BY ord) - 1 AS position, quality AS value,
              false AS truncated
       FROM docs""",
    using=(DOCS,),
)
def get_values(spark, folder):
    return sc.get_values(ct.docs(spark, folder), "quality", limit=0)


@query(
    "get_values_limited",
    """SELECT row_number() OVER (ORDER BY score DESC, sample_id DESC) - 1 AS position,
              score AS value, (SELECT count(*) FROM samples) > 10000 AS truncated
       FROM samples ORDER BY score DESC, sample_id DESC LIMIT 10000""",
    using=(SAMPLES,),
)
def get_values_limited(spark, folder):
    return sc.get_values(sc.sort_by(ct.samples(spark, folder), "score", reverse=True), "score")


@query(
    "resolve_path",
    "SELECT sample_id, tag AS value FROM detections",
    using=(DETECTIONS,),
)
def resolve_path(spark, folder):
    return sc.resolve_path(ct.samples(spark, folder).df, "detections.tags", keep=["sample_id"])


@query(
    "count_sample_tags",
    """SELECT tag, count(*) AS n FROM
       (SELECT lang AS tag FROM docs UNION ALL SELECT source FROM docs) GROUP BY tag""",
    using=(DOCS,),
)
def count_sample_tags(spark, folder):
    return sc.count_sample_tags(ct.docs(spark, folder))


@query(
    "measures",
    """SELECT * FROM (SELECT min(score) AS score_min, max(score) AS score_max FROM samples),
              (SELECT round(avg(confidence), 6) AS mean_confidence, round(sum(confidence), 4) AS sum_confidence,
                      round(stddev_pop(confidence), 6) AS std_confidence, count(*) AS n_labels,
                      count(DISTINCT label) AS n_classes FROM detections)""",
    using=(SAMPLES, DETECTIONS),
)
def measures(spark, folder):
    """Six measures of three fields, one of the samples and two of their labels, in one scan."""
    confidence, label = "detections.confidence", "detections.label"
    row = sc.measures(
        ct.samples(spark, folder),
        {
            "score": ("bounds", "score"), "mean_confidence": ("mean", confidence), "sum_confidence": ("sum", confidence),
            "std_confidence": ("std", confidence), "n_labels": ("count", label), "n_classes": ("distinct_count", label),
        },
    )
    return row.select(
        F.col("score.min").alias("score_min"), F.col("score.max").alias("score_max"),
        *[F.round(c, places).alias(c) for c, places in (("mean_confidence", 6), ("sum_confidence", 4), ("std_confidence", 6))],
        "n_labels", "n_classes",
    )
