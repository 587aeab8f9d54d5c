"""View stages."""

from __future__ import annotations

from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.plans.staging import new_path
from samplecraft.sources import curation_tables as ct

from .book import DETECTIONS, DOCS, PAIRS, SAMPLES, TURNS, query


def label_text(df, *keep, part="label"):
    """Label lists as text, so that results compare across engines."""
    values = F.transform("detections", lambda l: l[part])
    return df.select(
        *keep,
        F.size("detections").cast("long").alias("n"),
        F.array_join(values, ",").alias("labels"),
    )


# -- whole samples -------------------------------------------------------------------


@query(
    "match",
    "SELECT sample_id, n_chars FROM docs WHERE lang = 'en' AND n_chars > 500",
    using=(DOCS,),
)
def match(spark, folder):
    view = sc.match(ct.docs(spark, folder), "lang = 'en' AND n_chars > 500")
    return view.rows().select("sample_id", "n_chars")


@query(
    "match_null_is_false",
    "SELECT sample_id, quality FROM docs WHERE quality = 1",
    using=(DOCS,),
)
def match_null_is_false(spark, folder):
    view = sc.match(ct.docs(spark, folder), F.col("quality") == 1)
    return view.rows().select("sample_id", "quality")


@query(
    "match_labels",
    """SELECT sample_id FROM detections WHERE label = 'R' AND confidence > 0.9
       GROUP BY sample_id""",
    using=(DETECTIONS,),
)
def match_labels(spark, folder):
    view = sc.match_labels(
        ct.samples(spark, folder), "l.label = 'R' AND l.confidence > 0.9", fields="detections"
    )
    return view.rows().select("sample_id")


@query(
    "match_labels_negated",
    """SELECT sample_id FROM samples WHERE sample_id NOT IN
       (SELECT sample_id FROM detections WHERE label = 'R' AND confidence > 0.9)""",
    using=(SAMPLES, DETECTIONS),
)
def match_labels_negated(spark, folder):
    view = sc.match_labels(
        ct.samples(spark, folder),
        lambda l: (l["label"] == "R") & (l["confidence"] > 0.9),
        bool=False,
    )
    return view.rows().select("sample_id")


@query(
    "match_tags",
    "SELECT sample_id FROM docs WHERE lang IN ('fr', 'src3') OR source IN ('fr', 'src3')",
    using=(DOCS,),
)
def match_tags(spark, folder):
    return sc.match_tags(ct.docs(spark, folder), ["fr", "src3"]).rows().select("sample_id")


@query(
    "match_tags_all",
    "SELECT sample_id FROM docs WHERE lang = 'en' AND source = 'src3'",
    using=(DOCS,),
)
def match_tags_all(spark, folder):
    view = sc.match_tags(ct.docs(spark, folder), ["en", "src3"], all=True)
    return view.rows().select("sample_id")


@query(
    "match_tags_negated",
    "SELECT sample_id FROM docs WHERE lang NOT IN ('en') AND source NOT IN ('en')",
    using=(DOCS,),
)
def match_tags_negated(spark, folder):
    return sc.match_tags(ct.docs(spark, folder), "en", bool=False).rows().select("sample_id")


@query(
    "filter_field",
    "SELECT sample_id, n_chars FROM docs WHERE n_chars BETWEEN 100 AND 1000",
    using=(DOCS,),
)
def filter_field(spark, folder):
    view = sc.filter_field(ct.docs(spark, folder), "n_chars", "n_chars BETWEEN 100 AND 1000")
    return view.rows().select("sample_id", "n_chars")


@query(
    "filter_field_keeping_samples",
    "SELECT sample_id, CASE WHEN n_chars > 1000 THEN n_chars END AS n_chars FROM docs",
    using=(DOCS,),
)
def filter_field_keeping_samples(spark, folder):
    view = sc.filter_field(
        ct.docs(spark, folder), "n_chars", F.col("n_chars") > 1000, only_matches=False
    )
    return view.rows().select("sample_id", "n_chars")


@query(
    "exists",
    "SELECT sample_id, quality FROM docs WHERE quality IS NOT NULL",
    using=(DOCS,),
)
def exists(spark, folder):
    return sc.exists(ct.docs(spark, folder), "quality").rows().select("sample_id", "quality")


@query(
    "exists_negated", "SELECT sample_id FROM docs WHERE quality IS NULL", using=(DOCS,)
)
def exists_negated(spark, folder):
    view = sc.exists(ct.docs(spark, folder), "quality", bool=False)
    return view.rows().select("sample_id")


@query(
    "select",
    """SELECT sample_id, lang FROM docs
       WHERE ord IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    using=(DOCS,),
)
def select(spark, folder):
    good = ct.table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return sc.select(ct.docs(spark, folder), good).rows().select("sample_id", "lang")


@query(
    "select_ordered",
    """SELECT sample_id, row_number() OVER (ORDER BY l.toxic DESC, l.doc_id DESC) - 1 AS position
       FROM docs JOIN labels l ON l.doc_id = docs.ord""",
    using=(DOCS,),
)
def select_ordered(spark, folder):
    labels = ct.table(spark, folder, "labels")
    # Toxic documents first, later ids before earlier ones.
    place = (F.lit(1) - F.col("toxic")) * 1_000_000_000 - F.col("doc_id")
    ids = labels.select("doc_id", place.alias("position"))
    view = sc.select(ct.docs(spark, folder), ids, ordered=True)
    return sc.with_position(view).select("sample_id", "position")


@query(
    "select_by",
    "SELECT sample_id, lang FROM docs WHERE lang IN ('fr', 'de')",
    using=(DOCS,),
)
def select_by(spark, folder):
    view = sc.select_by(ct.docs(spark, folder), "lang", ["fr", "de", "xx"])
    return view.rows().select("sample_id", "lang")


@query(
    "select_by_ordered",
    """SELECT sample_id, lang, row_number() OVER (
         ORDER BY CASE lang WHEN 'fr' THEN 0 WHEN 'de' THEN 1 ELSE 2 END, sample_id
       ) - 1 AS position
       FROM docs WHERE lang IN ('fr', 'de', 'es')""",
    using=(DOCS,),
)
def select_by_ordered(spark, folder):
    view = sc.select_by(ct.docs(spark, folder), "lang", ["fr", "de", "fr", "es"], ordered=True)
    return sc.with_position(view).select("sample_id", "lang", "position")


@query(
    "select_group_slices",
    "SELECT sample_id, slice, text FROM turns WHERE slice IN ('user', 'system')",
    using=(TURNS,),
)
def select_group_slices(spark, folder):
    view = sc.select_group_slices(
        ct.turns(spark, folder), slices=["user", "system"], media_type="text"
    )
    return view.rows().select("sample_id", "slice", "text")


@query(
    "filter_view",
    """SELECT sample_id FROM docs
       WHERE quality = 1 AND n_chars > 100 AND toxic IS NOT NULL
         AND (lang IN ('en', 'fr') OR source IN ('en', 'fr'))
         AND ord IN (SELECT doc_id FROM labels WHERE toxic = 0)
       ORDER BY ord LIMIT 50""",
    using=(DOCS,),
)
def filter_view(spark, folder):
    calm = ct.table(spark, folder, "labels").filter("toxic = 0").select("doc_id")
    view = sc.filter_view(
        ct.docs(spark, folder),
        filters={"quality": 1},
        match="n_chars > 100",
        exists="toxic",
        tags=["en", "fr"],
        sample_ids=calm,
        limit=50,
    )
    return view.rows().select("sample_id")


@query(
    "facet_filter_labels",
    """SELECT sample_id, count(*) AS n, string_agg(id, ',' ORDER BY place) AS labels
       FROM detections WHERE label IN ('A', 'N') AND confidence BETWEEN 0.2 AND 0.6
       GROUP BY sample_id""",
    using=(DETECTIONS,),
)
def facet_filter_labels(spark, folder):
    view = sc.facet_filter(
        ct.samples(spark, folder),
        {
            "detections.label": {"values": ["A", "N"]},
            "detections.confidence": {"range": [0.2, 0.6], "onlyMatch": True},
        },
    )
    return label_text(view.rows(), "sample_id", part="id")


@query(
    "facet_filter_matching",
    """SELECT sample_id, count(*) AS n FROM detections WHERE sample_id IN
       (SELECT sample_id FROM detections WHERE label <> 'N')
       GROUP BY sample_id""",
    using=(DETECTIONS,),
)
def facet_filter_matching(spark, folder):
    view = sc.facet_filter(
        ct.samples(spark, folder),
        {"detections.label": {"values": ["N"], "exclude": True, "isMatching": True}},
    )
    return view.rows().select("sample_id", F.size("detections").cast("long").alias("n"))


@query(
    "facet_filter_numbers",
    """SELECT event_id, value FROM events
       WHERE value BETWEEN 50 AND 100 AND event_type NOT IN ('click', 'view')""",
)
def facet_filter_numbers(spark, folder):
    view = sc.facet_filter(
        ct.events(spark, folder),
        {
            "value": {"range": [50, 100], "none": True},
            "event_type": {"values": ["click", "view"], "exclude": True},
        },
    )
    return view.rows().select("event_id", "value")


@query(
    "facet_filter_booleans",
    "SELECT sample_id FROM docs WHERE quality = 0 OR quality IS NULL",
    using=(DOCS,),
)
def facet_filter_booleans(spark, folder):
    ds = ct.docs(spark, folder)
    ds = ds.with_df(ds.df.withColumn("good", F.col("quality") == 1))
    view = sc.facet_filter(ds, {"good": {"true": False, "false": True, "none": True}})
    return view.rows().select("sample_id")


# -- inside label lists --------------------------------------------------------------


@query(
    "filter_labels",
    """SELECT sample_id, count(*) AS n, string_agg(id, ',' ORDER BY place) AS labels
       FROM detections WHERE confidence > 0.5 GROUP BY sample_id""",
    using=(DETECTIONS,),
)
def filter_labels(spark, folder):
    view = sc.filter_labels(ct.samples(spark, folder), "detections", "l.confidence > 0.5")
    return label_text(view.rows(), "sample_id", part="id")


@query(
    "filter_labels_keeping_samples",
    """SELECT s.sample_id, count(d.id) AS n FROM samples s
       LEFT JOIN detections d ON d.sample_id = s.sample_id AND d.label = 'R'
       GROUP BY s.sample_id""",
    using=(SAMPLES, DETECTIONS),
)
def filter_labels_keeping_samples(spark, folder):
    view = sc.filter_labels(
        ct.samples(spark, folder), "detections", lambda l: l["label"] == "R", only_matches=False
    )
    return view.rows().select("sample_id", F.size("detections").cast("long").alias("n"))


@query(
    "select_labels",
    """SELECT sample_id, count(*) AS n, string_agg(id, ',' ORDER BY place) AS labels
       FROM detections WHERE tag = 'F' GROUP BY sample_id""",
    using=(DETECTIONS,),
)
def select_labels(spark, folder):
    view = sc.select_labels(ct.samples(spark, folder), tags=["F"], fields=["detections"])
    return label_text(view.rows(), "sample_id", part="id")


@query(
    "limit_labels",
    """SELECT s.sample_id, count(d.id) AS n,
              coalesce(string_agg(d.id, ',' ORDER BY d.place), '') AS labels
       FROM samples s LEFT JOIN detections d ON d.sample_id = s.sample_id AND d.place <= 2
       GROUP BY s.sample_id""",
    using=(SAMPLES, DETECTIONS),
)
def limit_labels(spark, folder):
    view = sc.limit_labels(ct.samples(spark, folder), "detections", 2)
    return label_text(view.rows(), "sample_id", part="id")


@query(
    "map_labels",
    """SELECT s.sample_id, count(d.id) AS n,
              coalesce(string_agg(CASE d.label WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned'
                                  ELSE d.label END, ',' ORDER BY d.place), '') AS labels
       FROM samples s LEFT JOIN detections d ON d.sample_id = s.sample_id
       GROUP BY s.sample_id""",
    using=(SAMPLES, DETECTIONS),
)
def map_labels(spark, folder):
    view = sc.map_labels(
        ct.samples(spark, folder), "detections", {"A": "accepted", "R": "returned"}
    )
    return label_text(view.rows(), "sample_id")


@query(
    "to_patches",
    """SELECT id AS patch_id, sample_id, 'order/' || ord AS filepath, label, confidence
       FROM detections""",
    using=(DETECTIONS,),
)
def to_patches(spark, folder):
    patches = sc.to_patches(ct.samples(spark, folder), "detections").rows()
    return patches.select(
        "patch_id", "sample_id", "filepath", "detections.label", "detections.confidence"
    )


# -- fields --------------------------------------------------------------------------


@query(
    "select_fields",
    "SELECT sample_id, filepath, lang || ',' || source AS tags, quality FROM docs",
    using=(DOCS,),
)
def select_fields(spark, folder):
    view = sc.select_fields(ct.docs(spark, folder), ["quality"])
    return view.rows().withColumn("tags", F.array_join("tags", ","))


@query(
    "select_fields_nested",
    """SELECT sample_id, filepath, tag_1 || ',' || tag_2 AS tags, label, confidence
       FROM (SELECT *, 'order/' || ord AS filepath FROM detections)""",
    using=(DETECTIONS,),
)
def select_fields_nested(spark, folder):
    view = sc.select_fields(
        ct.samples(spark, folder), ["detections.label", "detections.confidence"]
    )
    rows = view.rows().withColumn("tags", F.array_join("tags", ","))
    return rows.withColumn("d", F.explode("detections")).drop("detections").select(
        "*", "d.*"
    ).drop("d")


@query(
    "exclude_fields",
    "SELECT sample_id, ord, filepath, lang || ',' || source AS tags, lang, source, n_chars FROM docs",
    using=(DOCS,),
)
def exclude_fields(spark, folder):
    view = sc.exclude_fields(ct.docs(spark, folder), ["quality", "toxic"])
    return view.rows().withColumn("tags", F.array_join("tags", ","))


@query(
    "exclude_fields_nested",
    "SELECT sample_id, id, label, tag AS label_tags FROM detections",
    using=(DETECTIONS,),
)
def exclude_fields_nested(spark, folder):
    view = sc.exclude_fields(
        ct.samples(spark, folder), ["detections.box", "detections.confidence", "score"]
    )
    labels = view.rows().select("sample_id", F.explode("detections").alias("d"))
    return labels.select("sample_id", "d.*").select(
        "sample_id", "id", "label", F.array_join("tags", ",").alias("label_tags")
    )


# -- order ---------------------------------------------------------------------------


@query(
    "sort_by",
    """SELECT sample_id, n_chars,
              row_number() OVER (ORDER BY n_chars DESC, sample_id DESC) - 1 AS position
       FROM docs""",
    using=(DOCS,),
)
def sort_by(spark, folder):
    view = sc.sort_by(ct.docs(spark, folder), "n_chars", reverse=True)
    return sc.with_position(view).select("sample_id", "n_chars", "position")


@query(
    "sort_by_expression",
    """SELECT sample_id,
              row_number() OVER (ORDER BY quality * n_chars NULLS FIRST, sample_id) - 1 AS position
       FROM docs""",
    using=(DOCS,),
)
def sort_by_expression(spark, folder):
    view = sc.sort_by(ct.docs(spark, folder), "quality * n_chars")
    return sc.with_position(view).select("sample_id", "position")


@query(
    "limit",
    "SELECT sample_id, n_chars FROM docs ORDER BY n_chars DESC, sample_id DESC LIMIT 100",
    using=(DOCS,),
)
def limit(spark, folder):
    view = sc.limit(sc.sort_by(ct.docs(spark, folder), "n_chars", reverse=True), 100)
    return view.rows().select("sample_id", "n_chars")


@query(
    "limit_large",
    "SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 6000",
)
def limit_large(spark, folder):
    view = sc.limit(sc.sort_by(ct.events(spark, folder), "value"), 6000)
    return view.rows().select("event_id", "value")


def _line_items(spark, folder):
    """Line items by order number, which many of them share."""
    return sc.Dataset(ct.table(spark, folder, "lineitem"), id_col="l_orderkey")


def _order_counts(view):
    return view.df.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "limit_repeated_ids",
    """SELECT l_orderkey, count(*) AS n FROM
       (SELECT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 2001) GROUP BY l_orderkey""",
)
def limit_repeated_ids(spark, folder):
    return _order_counts(sc.limit(_line_items(spark, folder), 2001))


@query(
    "skip_repeated_ids",
    """SELECT l_orderkey, count(*) AS n FROM
       (SELECT l_orderkey FROM lineitem ORDER BY l_orderkey OFFSET 2002) GROUP BY l_orderkey""",
)
def skip_repeated_ids(spark, folder):
    return _order_counts(sc.skip(_line_items(spark, folder), 2002))


@query(
    "skip",
    """SELECT sample_id FROM docs ORDER BY lang, sample_id OFFSET 137""",
    using=(DOCS,),
)
def skip(spark, folder):
    view = sc.skip(sc.sort_by(ct.docs(spark, folder), "lang"), 137)
    return view.rows().select("sample_id")


@query(
    "skip_large",
    "SELECT event_id, value FROM events ORDER BY event_type DESC, event_id DESC OFFSET 6000",
)
def skip_large(spark, folder):
    view = sc.skip(sc.sort_by(ct.events(spark, folder), "event_type", reverse=True), 6000)
    return view.rows().select("event_id", "value")


@query(
    "page",
    "SELECT sample_id FROM samples ORDER BY score, sample_id LIMIT 25 OFFSET 50",
    using=(SAMPLES,),
)
def page(spark, folder):
    view = sc.page(sc.sort_by(ct.samples(spark, folder), "score"), 50, 25)
    return view.rows().select("sample_id")


@query(
    "take",
    "SELECT sample_id FROM docs ORDER BY md5('51:' || sample_id), sample_id LIMIT 100",
    using=(DOCS,),
)
def take(spark, folder):
    return sc.take(ct.docs(spark, folder), 100, seed=51).rows().select("sample_id")


@query(
    "shuffle",
    """SELECT sample_id, row_number() OVER (ORDER BY md5('7:' || sample_id), sample_id) - 1
              AS position
       FROM docs""",
    using=(DOCS,),
)
def shuffle(spark, folder):
    view = sc.shuffle(ct.docs(spark, folder), seed=7)
    return sc.with_position(view).select("sample_id", "position")


@query(
    "group_by",
    """SELECT source AS key, count(*) AS n, arg_min(sample_id, ord) AS first_id
       FROM docs GROUP BY source""",
    using=(DOCS,),
)
def group_by(spark, folder):
    return sc.group_by(ct.docs(spark, folder), "source").rows()


@query(
    "group_by_reversed",
    """SELECT quality AS key, count(*) AS n, first(sample_id ORDER BY n_chars DESC, sample_id DESC)
              AS first_id
       FROM docs GROUP BY quality""",
    using=(DOCS,),
)
def group_by_reversed(spark, folder):
    view = sc.sort_by(ct.docs(spark, folder), "n_chars", reverse=True)
    return sc.group_by(view, "quality").rows()


@query(
    "group_members",
    """SELECT sample_id, group_id,
              row_number() OVER (ORDER BY slice, group_id, turn) - 1 AS position
       FROM turns""",
    using=(TURNS,),
)
def group_members(spark, folder):
    view = sc.group_members(ct.turns(spark, folder), "slice")
    return sc.with_position(view).select("sample_id", "group_id", "position")


@query(
    "sort_by_similarity",
    """SELECT v.vec_id, round(1 - list_cosine_similarity(v.e, m.e), 6) AS distance
       FROM v, (SELECT list(x ORDER BY i) AS e FROM (
           SELECT i, avg(e[i]) AS x FROM v, range(1, 65) t(i) WHERE label = 3 GROUP BY i)) m
       ORDER BY 1 - list_cosine_similarity(v.e, m.e), v.vec_id LIMIT 50""",
    using=(PAIRS,),
)
def sort_by_similarity(spark, folder):
    ds = ct.vecs(spark, folder)
    threes = ds.df.filter("label = 3").select("vec_id")
    view = sc.sort_by_similarity(ds, threes, k=50, brain_key="embedding", dist_field="distance")
    return view.rows().select("vec_id", F.round("distance", 6).alias("distance"))


_NEAR_INDEXED = """SELECT '{0}' AS searched, v.vec_id, round(1 - list_cosine_similarity(v.e, m.e), 6) AS distance
       FROM v, (SELECT e FROM v WHERE vec_id = 0) m WHERE {1}
       ORDER BY 1 - list_cosine_similarity(v.e, m.e), v.vec_id LIMIT 40"""


@query(
    "similarity_index",
    f"SELECT * FROM ({_NEAR_INDEXED.format('all', 'true')}) UNION ALL SELECT * FROM ({_NEAR_INDEXED.format('view', 'v.label < 3')})",
    using=(PAIRS,),
)
def similarity_index(spark, folder):
    """The nearest of all vectors, and of a view, out of an index that is built once and
    opened by its key."""
    ds, place = ct.vecs(spark, folder), new_path(spark, "indexes")
    sc.build_similarity_index(ds, "by_meaning", place, field="embedding", cell_rows=64)
    index = sc.open_similarity_index(spark, "by_meaning", place)

    def found(name, view):
        near = sc.sort_by_similarity(view, [0], k=40, dist_field="distance", index=index)
        return near.rows().select(F.lit(name).alias("searched"), "vec_id", F.round("distance", 6).alias("distance"))

    return found("all", ds).unionByName(found("view", sc.match(ds, "label < 3")))


@query(
    "apply_stages",
    """SELECT sample_id, n_chars FROM docs
       WHERE lang = 'en' AND quality IS NOT NULL
       ORDER BY n_chars DESC, sample_id DESC LIMIT 40 OFFSET 10""",
    using=(DOCS,),
)
def apply_stages(spark, folder):
    view = sc.apply_stages(
        ct.docs(spark, folder),
        [
            {"type": "MatchTags", "tags": ["en"]},
            {"type": "Exists", "field": "quality"},
            {"type": "SortBy", "field_or_expr": "n_chars", "reverse": True},
            {"type": "Skip", "skip": 10},
            {"type": "Limit", "limit": 40},
        ],
    )
    return view.rows().select("sample_id", "n_chars")
