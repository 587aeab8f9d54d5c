"""Datasets by name, their schemas and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.plans.staging import new_path
from samplecraft.sources import curation_tables as ct

from .book import DOCS, query

TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation "
    "orders pages part region supplier"
).split()


@query(
    "list_datasets",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS num_samples, true AS persistent FROM {t}"
        for t in TABLES
    ),
)
def list_datasets(spark, folder):
    sources = {t: f"{folder.rstrip('/')}/{t}.parquet" for t in TABLES}
    return sc.list_datasets(spark, sources).select("name", "num_samples", "persistent")


@query(
    "load_dataset",
    """SELECT 'documents' AS name, count(*) AS num_samples,
              'doc_id,text,lang,source,n_chars' AS fields
       FROM documents""",
)
def load_dataset(spark, folder):
    sources = {"documents": f"{folder.rstrip('/')}/documents.parquet"}
    ds = sc.load_dataset(spark, "documents", sources, id_col="doc_id")
    return sc.dataset_info(ds).select(
        "name", "num_samples", F.array_join("fields", ",").alias("fields")
    )


@query(
    "dataset_summary",
    """, long AS (
         SELECT 'ord' AS field, CAST(ord AS VARCHAR) AS value FROM docs
         UNION ALL SELECT 'tags', lang FROM docs
         UNION ALL SELECT 'tags', source FROM docs
         UNION ALL SELECT 'lang', lang FROM docs
         UNION ALL SELECT 'source', source FROM docs
         UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM docs
         UNION ALL SELECT 'quality', CAST(quality AS VARCHAR) FROM docs
         UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM docs
       ), counted AS (SELECT field, value, count(*) AS n FROM long GROUP BY field, value)
       SELECT * FROM counted WHERE field IN
         (SELECT field FROM counted GROUP BY field HAVING count(*) < 100)""",
    using=(DOCS,),
)
def dataset_summary(spark, folder):
    return sc.dataset_summary(ct.docs(spark, folder)).value_counts


@query(
    "dataset_overview",
    """SELECT 'docs' AS name, 'text' AS media_type, count(*) AS num_samples,
              arg_min(sample_id, ord) AS first_sample_id
       FROM docs""",
    using=(DOCS,),
)
def dataset_overview(spark, folder):
    return sc.dataset_summary(ct.docs(spark, folder)).overview


# field, type, subfield, and the SQL that tests whether the value is there
_DOC_FIELDS = [
    ("sample_id", "StringField", None, "sample_id"),
    ("ord", "IntField", None, "ord"),
    ("filepath", "StringField", None, "filepath"),
    ("tags", "ListField", "StringField", "lang"),
    ("lang", "StringField", None, "lang"),
    ("source", "StringField", None, "source"),
    ("n_chars", "IntField", None, "n_chars"),
    ("quality", "IntField", None, "quality"),
    ("toxic", "IntField", None, "toxic"),
]


@query(
    "get_field_schema",
    " UNION ALL ".join(
        f"SELECT '{name}' AS field, '{kind}' AS type, "
        + (f"'{sub}'" if sub else "CAST(NULL AS VARCHAR)")
        + f" AS subfield, count(*) - count({value}) AS missing FROM docs"
        for name, kind, sub, value in _DOC_FIELDS
    ),
    using=(DOCS,),
)
def get_field_schema(spark, folder):
    """Each field's type, and how many samples lack it."""
    ds = ct.docs(spark, folder)
    missing = sc.find_issues(ds).filter("issue = 'null'").select("field", F.col("n").alias("missing"))
    schema = sc.get_field_schema(ds).select("field", "type", "subfield")
    return schema.join(missing, "field")


@query(
    "saved_view",
    "SELECT sample_id, n_chars FROM docs WHERE lang = 'fr' ORDER BY n_chars DESC, sample_id DESC LIMIT 30",
    using=(DOCS,),
)
def saved_view(spark, folder):
    french = sc.sort_by(sc.match_tags(ct.docs(spark, folder), "fr"), "n_chars", reverse=True)
    sc.save_view(french, "french_docs", replace=True)
    return sc.limit(sc.load_view(spark, "french_docs"), 30).rows().select("sample_id", "n_chars")


@query(
    "saved_view_in_folder",
    """SELECT 'samples' AS kind, sample_id, n_chars FROM docs WHERE lang = 'fr'
       UNION ALL SELECT 'stages', sample_id, n_chars FROM docs WHERE lang = 'fr'""",
    using=(DOCS,),
)
def saved_view_in_folder(spark, folder):
    """A view saved to a folder, as samples and as stages, and loaded from there."""
    ds, place = ct.docs(spark, folder), new_path(spark, "views")
    stages = [{"type": "MatchTags", "tags": ["fr"]}]
    sc.save_view(sc.apply_stages(ds, stages), "samples", place)
    sc.save_view(ds, "stages", place, stages=stages)

    def loaded(name):
        view = sc.load_view(spark, name, place, ds)
        return view.rows().select(F.lit(name).alias("kind"), "sample_id", "n_chars")

    return loaded("samples").unionByName(loaded("stages"))


_ROUND_TRIP = "SELECT sample_id, lang || ',' || source AS tags, n_chars, quality FROM docs"


def _read_back(ds):
    return ds.rows().select(
        "sample_id", F.array_join("tags", ",").alias("tags"), "n_chars", "quality"
    )


@query("clone_dataset", _ROUND_TRIP, using=(DOCS,))
def clone_dataset(spark, folder):
    return _read_back(sc.clone_dataset(ct.docs(spark, folder), new_path(spark, "clone")))


def _through(spark, folder, format):
    ds = ct.docs(spark, folder)
    path = new_path(spark, f"export-{format}")
    sc.export_samples(ds, path, format=format)
    return _read_back(sc.import_samples(spark, path, format=format, schema=ds.rows().schema))


@query("export_import_json", _ROUND_TRIP, using=(DOCS,))
def export_import_json(spark, folder):
    return _through(spark, folder, "json")


@query("export_import_csv", _ROUND_TRIP, using=(DOCS,))
def export_import_csv(spark, folder):
    return _through(spark, folder, "csv")


@query("export_import_orc", _ROUND_TRIP, using=(DOCS,))
def export_import_orc(spark, folder):
    return _through(spark, folder, "orc")
