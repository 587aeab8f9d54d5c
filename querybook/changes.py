"""Mutations of samples, values and schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.plans.staging import new_path
from samplecraft.sources import curation_tables as ct

from .book import DOCS, query


def tagged(ds):
    return ds.rows().select("sample_id", F.array_join("tags", ",").alias("tags"))


@query(
    "add_samples",
    """SELECT sample_id, ord, filepath, lang FROM docs
       UNION ALL
       SELECT md5(concat_ws(chr(31), 'crawl-1', page_id, url)),
              (SELECT max(ord) FROM docs) + 1 + page_id, url, 'xx'
       FROM pages""",
    using=(DOCS,),
)
def add_samples(spark, folder):
    pages = ct.table(spark, folder, "pages").select(
        F.col("page_id").alias("position"), F.col("url").alias("filepath"), F.lit("xx").alias("lang")
    )
    grown = sc.add_samples(ct.docs(spark, folder), pages, batch="crawl-1").dataset
    return grown.rows().select("sample_id", "ord", "filepath", "lang")


@query("add_samples_count", "SELECT count(*) AS n FROM pages")
def add_samples_count(spark, folder):
    pages = ct.table(spark, folder, "pages").select(
        F.col("page_id").alias("position"), F.col("url").alias("filepath")
    )
    return sc.add_samples(ct.docs(spark, folder), pages, batch="crawl-1").count()


@query(
    "set_values",
    """SELECT sample_id, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'bad' END AS grade FROM docs""",
    using=(DOCS,),
)
def set_values(spark, folder):
    grades = ct.table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad")
    )
    graded = sc.set_values(ct.docs(spark, folder), "grade", grades).dataset
    return graded.rows().select("sample_id", "grade")


@query(
    "set_values_unmatched_null",
    """SELECT sample_id, CASE WHEN quality IS NOT NULL THEN -n_chars END AS n_chars FROM docs""",
    using=(DOCS,),
)
def set_values_unmatched_null(spark, folder):
    ds = ct.docs(spark, folder)
    known = sc.exists(ds, "quality").df.select("sample_id", (-F.col("n_chars")).alias("v"))
    return sc.set_values(ds, "n_chars", known).dataset.rows().select("sample_id", "n_chars")


@query(
    "set_values_keep_unmatched",
    """SELECT sample_id, CASE WHEN quality IS NOT NULL THEN -n_chars ELSE n_chars END AS n_chars
       FROM docs""",
    using=(DOCS,),
)
def set_values_keep_unmatched(spark, folder):
    ds = ct.docs(spark, folder)
    known = sc.exists(ds, "quality").df.select("sample_id", (-F.col("n_chars")).alias("v"))
    kept = sc.set_values(ds, "n_chars", known, keep_unmatched=True).dataset
    return kept.rows().select("sample_id", "n_chars")


@query(
    "set_values_count",
    "SELECT count(*) AS n FROM docs WHERE quality IS NOT NULL",
    using=(DOCS,),
)
def set_values_count(spark, folder):
    labels = ct.table(spark, folder, "labels").select("doc_id", "toxic")
    return sc.set_values(ct.docs(spark, folder), "toxic", labels).count()


@query(
    "tag_samples",
    """SELECT sample_id, lang || ',' || source || CASE WHEN n_chars <= 1000 THEN ''
              WHEN lang = 'en' THEN ',long' ELSE ',long,en' END AS tags
       FROM docs""",
    using=(DOCS,),
)
def tag_samples(spark, folder):
    ds = ct.docs(spark, folder)
    change = sc.tag_samples(ds, ["long", "en", "long"], view=sc.match(ds, "n_chars > 1000"))
    return tagged(change.dataset)


@query(
    "tag_samples_by_id",
    """SELECT sample_id, lang || ',' || source ||
              CASE WHEN ord IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN ',toxic' ELSE '' END
              AS tags
       FROM docs""",
    using=(DOCS,),
)
def tag_samples_by_id(spark, folder):
    toxic = ct.table(spark, folder, "labels").filter("toxic = 1").select("doc_id")
    return tagged(sc.tag_samples(ct.docs(spark, folder), "toxic", sample_ids=toxic).dataset)


@query(
    "tag_samples_count",
    "SELECT count(*) AS n FROM docs WHERE n_chars > 1000",
    using=(DOCS,),
)
def tag_samples_count(spark, folder):
    stages = [{"type": "Match", "filter": "n_chars > 1000"}]
    return sc.tag_samples(ct.docs(spark, folder), ["long"], view=stages).count()


@query(
    "untag_samples",
    """SELECT sample_id, CASE WHEN quality IS NOT NULL AND lang IN ('en', 'fr') THEN source
                              ELSE lang || ',' || source END AS tags
       FROM docs""",
    using=(DOCS,),
)
def untag_samples(spark, folder):
    ds = ct.docs(spark, folder)
    change = sc.untag_samples(ds, ["en", "fr"], view=sc.exists(ds, "quality"))
    return tagged(change.dataset)


@query(
    "untag_samples_count",
    "SELECT count(*) AS n FROM docs WHERE quality IS NOT NULL",
    using=(DOCS,),
)
def untag_samples_count(spark, folder):
    ds = ct.docs(spark, folder)
    return sc.untag_samples(ds, ["en"], view=sc.exists(ds, "quality")).count()


@query(
    "remap_values",
    """SELECT sample_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE lang END
              AS lang
       FROM docs""",
    using=(DOCS,),
)
def remap_values(spark, folder):
    ds = sc.remap_values(ct.docs(spark, folder), "lang", {"en": "english", "fr": "french"})
    return ds.rows().select("sample_id", "lang")


@query(
    "remap_values_by_table",
    """SELECT sample_id, CASE quality WHEN 1 THEN 'curated' ELSE filepath END AS filepath FROM docs""",
    using=(DOCS,),
)
def remap_values_by_table(spark, folder):
    ds = ct.docs(spark, folder)
    mapping = sc.match(ds, "quality = 1").df.select("filepath", F.lit("curated").alias("new"))
    return sc.remap_values(ds, "filepath", mapping).rows().select("sample_id", "filepath")


@query(
    "clone_field", "SELECT sample_id, n_chars, n_chars AS size FROM docs", using=(DOCS,)
)
def clone_field(spark, folder):
    ds = sc.clone_field(ct.docs(spark, folder), "n_chars", "size")
    return ds.rows().select("sample_id", "n_chars", "size")


@query(
    "add_sample_field",
    """SELECT sample_id, CAST(NULL AS VARCHAR) AS review, CAST(NULL AS DOUBLE) AS agreement,
              0 AS n_reviewers
       FROM docs""",
    using=(DOCS,),
)
def add_sample_field(spark, folder):
    ds = sc.add_sample_field(ct.docs(spark, folder), "review", "StringField", description="verdict")
    ds = sc.add_sample_field(ds, "agreement", "FloatField")
    ds = sc.add_sample_field(ds, "reviewers", "ListField", subfield="StringField")
    reviewers = F.coalesce(F.size("reviewers"), F.lit(0)).alias("n_reviewers")
    return ds.rows().select("sample_id", "review", "agreement", reviewers)


@query(
    "infer_fields",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def infer_fields(spark, folder):
    ds = sc.infer_fields(ct.events(spark, folder), "props", into="typed")
    return ds.rows().select("event_id", "typed.k")


@query(
    "infer_fields_nested",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS of_string,
              CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice + 0.5 END AS price,
              CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS mixed
       FROM orders""",
)
def infer_fields_nested(spark, folder):
    """Keys that are called like types, nested objects, a key of mixed types, and arrays
    among the objects."""
    text = F.when(F.col("o_orderkey") % 5 == 0, "[1]").otherwise(
        F.concat(
            F.lit('{"STRING": {"VOID": "'), "o_orderstatus",
            F.lit('", "DECIMAL(3,1)": '), (F.col("o_totalprice") + 0.5).cast("string"),
            F.lit('}, "m": '), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit('"'), "o_orderkey", F.lit('"'))),
            F.lit("}"),
        )
    )
    rows = ct.table(spark, folder, "orders").select("o_orderkey", text.alias("doc"))
    typed = sc.infer_fields(sc.Dataset(rows, id_col="o_orderkey"), "doc").df
    inner = F.col("doc.STRING")
    return typed.select(
        F.col("o_orderkey").alias("id"), inner["VOID"].alias("of_string"), inner["DECIMAL(3,1)"].alias("price"), F.col("doc.m").alias("mixed")
    )


# -- stores: changes and batches written on their own ---------------------------------


def new_store(spark, folder):
    return sc.create_store(ct.docs(spark, folder), new_path(spark, "store"))


def long_and_french(store):
    """Three versions: long ones tagged, labelled ones that are long untagged, French ones tagged."""
    store.tag_samples("long", view=[{"type": "Match", "filter": "n_chars > 1000"}])
    store.untag_samples("long", view=lambda ds: sc.exists(ds, "quality"))
    store.tag_samples(["fr", "seen"], view=lambda ds: sc.match(ds, "lang = 'fr'"))
    return store


@query(
    "versioned_tags",
    """SELECT sample_id, lang || ',' || source || CASE WHEN n_chars > 1000 AND quality IS NULL THEN ',long' ELSE '' END
              || CASE WHEN lang = 'fr' THEN ',seen' ELSE '' END AS tags
       FROM docs""",
    using=(DOCS,),
)
def versioned_tags(spark, folder):
    return tagged(long_and_french(new_store(spark, folder)).dataset())


@query(
    "versioned_tags_before",
    """SELECT sample_id, lang || ',' || source || CASE WHEN n_chars > 1000 THEN ',long' ELSE '' END AS tags FROM docs""",
    using=(DOCS,),
)
def versioned_tags_before(spark, folder):
    """An earlier version, read after later ones were made."""
    return tagged(long_and_french(new_store(spark, folder)).dataset(1))


@query(
    "versioned_history",
    """SELECT CAST(0 AS BIGINT) AS version, 'compact' AS kind, count(*) AS n, count(*) AS rows FROM docs
       UNION ALL SELECT 1, 'change', count(*), count(*) FROM docs WHERE n_chars > 1000
       UNION ALL SELECT 2, 'change', count(*), count(*) FILTER (n_chars > 1000) FROM docs WHERE quality IS NOT NULL
       UNION ALL SELECT 3, 'change', count(*), count(*) FROM docs WHERE lang = 'fr'""",
    using=(DOCS,),
)
def versioned_history(spark, folder):
    """What each version counted, and the rows it wrote: those whose tags change."""
    return long_and_french(new_store(spark, folder)).history().select("version", "kind", "n", "rows")


@query(
    "versioned_values",
    """SELECT sample_id, CASE WHEN quality IS NOT NULL THEN CASE WHEN toxic = 1 THEN -1 ELSE quality * 10 END END AS grade,
              CASE WHEN toxic = 1 THEN 0 ELSE n_chars END AS n_chars
       FROM docs""",
    using=(DOCS,),
)
def versioned_values(spark, folder):
    """A field that is set for all, then for some; another one for some only."""
    store, labels = new_store(spark, folder), ct.table(spark, folder, "labels")
    store.set_values("grade", ct.table(spark, folder, "documents").select("doc_id", F.lit(5)))
    store.set_values("grade", labels.select("doc_id", F.col("quality") * 10))  # all others become null
    toxic = labels.filter("toxic = 1")
    store.set_values("grade", toxic.select("doc_id", F.lit(-1)), keep_unmatched=True)
    store.set_values("n_chars", toxic.select("doc_id", F.lit(0)), keep_unmatched=True)
    return store.dataset().rows().select("sample_id", "grade", "n_chars")


def crawled(spark, folder):
    return ct.table(spark, folder, "pages").select(
        F.col("page_id").alias("position"), F.col("url").alias("filepath"), F.lit("xx").alias("lang")
    )


@query(
    "versioned_append",
    """SELECT sample_id, ord, filepath, lang FROM docs
       UNION ALL
       SELECT md5(concat_ws(chr(31), 'crawl-1', page_id, url)),
              (SELECT max(ord) FROM docs) + 1 + page_id, url, 'xx'
       FROM pages""",
    using=(DOCS,),
)
def versioned_append(spark, folder):
    """A batch that is added twice, as a retry does, with a compaction between."""
    store = new_store(spark, folder)
    store.add_samples(crawled(spark, folder).filter("position % 2 = 0"), "crawl-1")
    store.add_samples(crawled(spark, folder), "crawl-1")
    store.compact()
    store.add_samples(crawled(spark, folder), "crawl-1")
    return store.dataset().rows().select("sample_id", "ord", "filepath", "lang")


@query(
    "versioned_append_history",
    """SELECT CAST(0 AS BIGINT) AS version, 'compact' AS kind, CAST(NULL AS VARCHAR) AS batch, count(*) AS rows FROM docs
       UNION ALL SELECT 1, 'samples', 'crawl-1', count(*) FROM pages
       UNION ALL SELECT 2, 'change', NULL, count(*) FROM pages
       UNION ALL SELECT 3, 'compact', NULL, (SELECT count(*) FROM docs) + count(*) FROM pages""",
    using=(DOCS,),
)
def versioned_append_history(spark, folder):
    """Rows written by an append, by tagging what it added, and by a compaction."""
    store = new_store(spark, folder)
    store.add_samples(crawled(spark, folder), "crawl-1")
    store.tag_samples("crawled", view=[{"type": "Match", "filter": "lang = 'xx'"}])
    store.compact()
    return store.history().select("version", "kind", "batch", "rows")
