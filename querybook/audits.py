"""Quality, similarity and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.plans.staging import new_path
from samplecraft.sources import curation_tables as ct

from .book import DETECTIONS, DOCS, PAIRS, query

THRESHOLD = 0.35  # the test vectors are random: few pairs are closer than this


@query(
    "find_issues",
    """, counts AS (
         SELECT 'sample_id' AS field, 'null' AS issue, count(*) - count(sample_id) AS n FROM docs
         UNION ALL SELECT 'ord', 'null', count(*) - count(ord) FROM docs
         UNION ALL SELECT 'filepath', 'null', count(*) - count(filepath) FROM docs
         UNION ALL SELECT 'tags', 'null', 0 FROM docs
         UNION ALL SELECT 'tags', 'empty_list', 0 FROM docs
         UNION ALL SELECT 'lang', 'null', count(*) - count(lang) FROM docs
         UNION ALL SELECT 'source', 'null', count(*) - count(source) FROM docs
         UNION ALL SELECT 'n_chars', 'null', count(*) - count(n_chars) FROM docs
         UNION ALL SELECT 'quality', 'null', count(*) - count(quality) FROM docs
         UNION ALL SELECT 'toxic', 'null', count(*) - count(toxic) FROM docs
         UNION ALL SELECT 'sample_id', 'empty_string', count(*) FILTER (sample_id = '') FROM docs
         UNION ALL SELECT 'filepath', 'empty_string', count(*) FILTER (filepath = '') FROM docs
         UNION ALL SELECT 'lang', 'empty_string', count(*) FILTER (lang = '') FROM docs
         UNION ALL SELECT 'source', 'empty_string', count(*) FILTER (source = '') FROM docs
         UNION ALL SELECT 'sample_id', 'duplicate', count(sample_id) - count(DISTINCT sample_id) FROM docs
         UNION ALL SELECT 'filepath', 'duplicate', count(filepath) - count(DISTINCT filepath) FROM docs
       )
       SELECT DISTINCT field, issue, n, round(n / (SELECT count(*) FROM docs), 6) AS share
       FROM counts""",
    using=(DOCS,),
)
def find_issues(spark, folder):
    issues = sc.find_issues(ct.docs(spark, folder))
    return issues.withColumn("share", F.round("share", 6))


@query(
    "find_issues_in_texts",
    """SELECT 'text' AS field, 'duplicate' AS issue, count(text) - count(DISTINCT text) AS n
       FROM documents
       UNION ALL SELECT 'text', 'null', count(*) - count(text) FROM documents
       UNION ALL SELECT 'text', 'empty_string', count(*) FILTER (text = '') FROM documents""",
)
def find_issues_in_texts(spark, folder):
    """Whole texts checked; equal texts are found by their SHA-256 digest, so that a
    digest and not the text is shuffled."""
    documents = ct.table(spark, folder, "documents")
    ds = sc.Dataset(
        documents.select("doc_id", "text", F.sha2("text", 256).alias("filepath")), id_col="doc_id"
    )
    issues = sc.find_issues(ds).select("field", "issue", "n")
    return issues.filter(
        "field = 'text' OR (field = 'filepath' AND issue = 'duplicate')"
    ).withColumn("field", F.lit("text"))


# -- similarity ----------------------------------------------------------------------


@query(
    "near_duplicates",
    f""", close AS (SELECT * FROM pairs WHERE cosine >= {THRESHOLD})
       SELECT min(a) AS id_a, b AS id_b, round(arg_min(cosine, a), 6) AS cosine, count(*) AS n_near
       FROM close GROUP BY b HAVING min(a) < b""",
    using=(PAIRS,),
)
def near_duplicates(spark, folder):
    found = sc.near_duplicates(ct.vecs(spark, folder), THRESHOLD, brain_key="embedding")
    return found.withColumn("cosine", F.round("cosine", 6))


@query(
    "near_duplicates_in_cells",
    f""", close AS (SELECT * FROM pairs WHERE cosine >= {THRESHOLD + 0.05})
       SELECT min(a) AS id_a, b AS id_b, round(arg_min(cosine, a), 6) AS cosine, count(*) AS n_near
       FROM close GROUP BY b HAVING min(a) < b""",
    using=(PAIRS,),
)
def near_duplicates_in_cells(spark, folder):
    found = sc.near_duplicates(
        ct.vecs(spark, folder), THRESHOLD + 0.05, brain_key="embedding", cell_rows=128
    )
    return found.withColumn("cosine", F.round("cosine", 6))


@query(
    "knn_join",
    """, near AS (
         SELECT a AS query_id, b AS neighbour_id, 1 - cosine AS distance,
                row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS rank
         FROM pairs
       )
       SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, round(distance, 6) AS distance
       FROM near WHERE rank <= 5""",
    using=(PAIRS,),
)
def knn_join(spark, folder):
    ds = ct.vecs(spark, folder)
    found = sc.knn_join(ds, ds, 5, brain_key="embedding", exclude_self=True)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "knn_join_other_table",
    """, near AS (
         SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id,
                list_distance(a.e, b.e) AS distance,
                row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id)
                  AS rank
         FROM v a JOIN v b ON a.label < 5 AND b.label >= 5
       )
       SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, round(distance, 6) AS distance
       FROM near WHERE rank <= 3""",
    using=(PAIRS,),
)
def knn_join_other_table(spark, folder):
    ds = ct.vecs(spark, folder)
    found = sc.knn_join(
        sc.match(ds, "label < 5"),
        sc.match(ds, "label >= 5"),
        3,
        brain_key="embedding",
        metric="euclidean",
        cell_rows=128,
    )
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "uniqueness",
    """, near AS (
         SELECT a AS id, 1 - cosine AS distance,
                row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS rank
         FROM pairs
       ), means AS (SELECT id, avg(distance) AS mean FROM near WHERE rank <= 5 GROUP BY id)
       SELECT id, round(mean / (SELECT max(mean) FROM means), 6) AS uniqueness FROM means""",
    using=(PAIRS,),
)
def uniqueness(spark, folder):
    found = sc.uniqueness(ct.vecs(spark, folder), k=5, brain_key="embedding")
    return found.withColumn("uniqueness", F.round("uniqueness", 6))


# -- classification ------------------------------------------------------------------

GUESSES = """guesses AS (
  SELECT sample_id, lang, n_chars, quality AS truth, CAST(n_chars > 500 AS INTEGER) AS pred
  FROM docs
)"""


def guessed(spark, folder):
    """All documents with a rule's guess at their quality, which is null for many."""
    ds = ct.docs(spark, folder)
    return ds.with_df(ds.df.withColumn("guess", (F.col("n_chars") > 500).cast("int")))


@query(
    "evaluate_classification",
    "SELECT sample_id, truth, pred, truth IS NOT DISTINCT FROM pred AS correct FROM guesses",
    using=(DOCS, GUESSES),
)
def evaluate_classification(spark, folder):
    return sc.evaluate_classification(guessed(spark, folder), "guess", "quality")


@query(
    "confusion_counts",
    "SELECT truth, pred, count(*) AS n FROM guesses GROUP BY truth, pred",
    using=(DOCS, GUESSES),
)
def confusion_counts(spark, folder):
    return sc.confusion_counts(evaluate_classification(spark, folder))


@query(
    "accuracy",
    """SELECT count(*) AS n, count(*) FILTER (truth IS NOT DISTINCT FROM pred) AS correct,
              round(avg(CAST(truth IS NOT DISTINCT FROM pred AS INTEGER)), 6) AS accuracy
       FROM guesses""",
    using=(DOCS, GUESSES),
)
def accuracy(spark, folder):
    scores = sc.accuracy(evaluate_classification(spark, folder))
    return scores.withColumn("accuracy", F.round("accuracy", 6))


def report_sql(source: str, keys: str) -> str:
    """Per-class scores of ``truth, pred`` rows, per keys."""
    by = f"{keys}, " if keys else ""
    return f"""SELECT {by}class, tp, fp, fn, tp + fn AS support,
              round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
              round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
              round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
       FROM (
         SELECT {by}class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp,
                CAST(sum(fn) AS BIGINT) AS fn
         FROM (
           SELECT {by}truth AS class, CAST(truth IS NOT DISTINCT FROM pred AS INTEGER) AS tp, 0 AS fp,
                  CAST(truth IS DISTINCT FROM pred AS INTEGER) AS fn FROM {source}
           UNION ALL
           SELECT {by}pred, 0, CAST(truth IS DISTINCT FROM pred AS INTEGER), 0 FROM {source}
         ) GROUP BY {by}class
       )"""


def rounded_scores(df, *more):
    for name in ("precision", "recall", "f1", *more):
        df = df.withColumn(name, F.round(name, 6))
    return df


@query("classification_report", report_sql("guesses", ""), using=(DOCS, GUESSES))
def classification_report(spark, folder):
    return rounded_scores(sc.classification_report(evaluate_classification(spark, folder)))


def by_slice_sql(sliced: str) -> str:
    return f""", sliced AS ({sliced}), scores AS ({report_sql("sliced", "overall, slice")}),
       rates AS (
         SELECT overall, slice, round(avg(CAST(truth IS NOT DISTINCT FROM pred AS INTEGER)), 6) AS accuracy
         FROM sliced GROUP BY overall, slice
       )
       SELECT scores.*, accuracy FROM scores JOIN rates USING (overall, slice)"""


@query(
    "evaluate_by_slice",
    by_slice_sql(
        """SELECT false AS overall, lang AS slice, truth, pred FROM guesses
           UNION ALL SELECT true, '(all)', truth, pred FROM guesses"""
    ),
    using=(DOCS, GUESSES),
)
def evaluate_by_slice(spark, folder):
    scores = sc.evaluate_by_slice(guessed(spark, folder), "guess", "quality", "lang")
    return rounded_scores(scores, "accuracy")


@query(
    "evaluate_by_predicate_slices",
    by_slice_sql(
        """SELECT false AS overall, 'short' AS slice, truth, pred FROM guesses WHERE n_chars < 800
           UNION ALL SELECT false, 'english', truth, pred FROM guesses WHERE lang = 'en'
           UNION ALL SELECT true, '(all)', truth, pred FROM guesses"""
    ),
    using=(DOCS, GUESSES),
)
def evaluate_by_predicate_slices(spark, folder):
    scores = sc.evaluate_by_slice(
        guessed(spark, folder),
        "guess",
        "quality",
        {"short": "n_chars < 800", "english": F.col("lang") == "en"},
    )
    return rounded_scores(scores, "accuracy")


# -- detections ----------------------------------------------------------------------

# Greedy matching one prediction at a time: round r of a (sample, label) group lets its
# r-th prediction take the best truth that is still free.
MATCHES = """truths AS (SELECT * FROM detections WHERE tag = 'F'),
preds AS (
  SELECT *, row_number() OVER (PARTITION BY sample_id, label ORDER BY confidence DESC, id) AS turn
  FROM detections WHERE tag = 'O'
), shared AS (
  SELECT p.sample_id, p.label, p.turn, p.id AS pred_id, t.id AS truth_id,
         greatest(least(p.x + 0.5, t.x + 0.5) - greatest(p.x, t.x), 0.0)
           * greatest(least(p.y + 0.5, t.y + 0.5) - greatest(p.y, t.y), 0.0) AS inter
  FROM preds p JOIN truths t ON t.sample_id = p.sample_id AND t.label = p.label
), options AS (
  SELECT sample_id, label, turn, pred_id, truth_id, inter / (0.25 + 0.25 - inter) AS iou
  FROM shared WHERE inter / (0.25 + 0.25 - inter) >= 0.5
), rounds AS (
  SELECT sample_id, label, CAST(0 AS BIGINT) AS turn, CAST([] AS VARCHAR[]) AS used,
         CAST(NULL AS VARCHAR) AS pred_id, CAST(NULL AS VARCHAR) AS truth_id,
         CAST(NULL AS DOUBLE) AS iou
  FROM (SELECT DISTINCT sample_id, label FROM options)
  UNION ALL
  SELECT r.sample_id, r.label, p.turn,
         CASE WHEN o.truth_id IS NULL THEN r.used ELSE list_append(r.used, o.truth_id) END,
         o.pred_id, o.truth_id, o.iou
  FROM rounds r
  JOIN preds p ON p.sample_id = r.sample_id AND p.label = r.label AND p.turn = r.turn + 1
  LEFT JOIN options o ON o.pred_id = p.id AND o.sample_id = p.sample_id
   AND NOT list_contains(r.used, o.truth_id)
  QUALIFY row_number() OVER (PARTITION BY r.sample_id, r.label ORDER BY o.iou DESC NULLS LAST, o.truth_id) = 1
), matches AS (SELECT sample_id, pred_id, truth_id, iou FROM rounds WHERE truth_id IS NOT NULL)"""


def split_detections(spark, folder):
    """Shipped line items as predictions of the finished ones."""
    ds = ct.samples(spark, folder)
    parts = {
        "predictions": F.filter("detections", lambda l: F.array_contains(l["tags"], "O")),
        "ground_truth": F.filter("detections", lambda l: F.array_contains(l["tags"], "F")),
    }
    return ds.with_df(ds.df.withColumns(parts))


@query(
    "evaluate_detections",
    "SELECT sample_id, pred_id, truth_id, round(iou, 6) AS iou FROM matches",
    using=(DETECTIONS, MATCHES),
)
def evaluate_detections(spark, folder):
    pairs = sc.evaluate_detections(split_detections(spark, folder), "predictions", "ground_truth")
    return pairs.withColumn("iou", F.round("iou", 6))


@query(
    "detection_report",
    """, outcomes AS (
         SELECT label, CASE WHEN id IN (SELECT pred_id FROM matches) THEN 'tp' ELSE 'fp' END AS type
         FROM preds
         UNION ALL
         SELECT label, 'fn' FROM truths WHERE id NOT IN (SELECT truth_id FROM matches)
       ), counts AS (
         SELECT label AS class, count(*) FILTER (type = 'tp') AS tp,
                count(*) FILTER (type = 'fp') AS fp, count(*) FILTER (type = 'fn') AS fn
         FROM outcomes GROUP BY label
       )
       SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
              round(2 * tp / (2 * tp + fp + fn), 6) AS f1
       FROM counts""",
    using=(DETECTIONS, MATCHES),
)
def detection_report(spark, folder):
    report = sc.detection_report(split_detections(spark, folder), "predictions", "ground_truth")
    return rounded_scores(report)


PATCHES = """SELECT p.sample_id, CASE WHEN m.truth_id IS NULL THEN 'fp' ELSE 'tp' END AS type,
              p.id AS pred_id, m.truth_id, round(m.iou, 6) AS iou
       FROM preds p LEFT JOIN matches m ON m.sample_id = p.sample_id AND m.pred_id = p.id
       UNION ALL
       SELECT t.sample_id, 'fn', NULL, t.id, NULL FROM truths t
       WHERE NOT EXISTS (SELECT 1 FROM matches m
                         WHERE m.sample_id = t.sample_id AND m.truth_id = t.id)"""


def _patches(ds):
    rows = sc.to_evaluation_patches(ds, "eval").rows()
    rows = rows.select("sample_id", "type", "pred_id", "truth_id", "iou")
    return rows.withColumn("iou", F.round("iou", 6))


@query("to_evaluation_patches", PATCHES, using=(DETECTIONS, MATCHES))
def to_evaluation_patches(spark, folder):
    return _patches(sc.store_evaluation(split_detections(spark, folder), "eval"))


@query("to_evaluation_patches_after_reload", PATCHES, using=(DETECTIONS, MATCHES))
def to_evaluation_patches_after_reload(spark, folder):
    """The run is saved with the dataset and found by its key in the copy."""
    ds = sc.store_evaluation(split_detections(spark, folder), "eval")
    return _patches(sc.clone_dataset(ds, new_path(spark, "evaluated")))


@query(
    "to_evaluation_patches_of_pairs",
    PATCHES,
    using=(
        DETECTIONS,
        """truths AS (
             SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY place) AS turn
             FROM detections WHERE tag = 'F'
           ), preds AS (
             SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY place) AS turn
             FROM detections WHERE tag = 'O'
           ), matches AS (
             SELECT p.sample_id, p.id AS pred_id, t.id AS truth_id, CAST(1.0 AS DOUBLE) AS iou
             FROM preds p JOIN truths t ON t.sample_id = p.sample_id AND t.turn = p.turn
           )""",
    ),
)
def to_evaluation_patches_of_pairs(spark, folder):
    """A match table from elsewhere: the n-th prediction with the n-th truth."""
    ds = split_detections(spark, folder)
    zipped = F.arrays_zip(
        F.col("predictions.id").alias("pred_id"), F.col("ground_truth.id").alias("truth_id")
    )
    pairs = ds.df.select("sample_id", F.explode(zipped).alias("p")).select(
        "sample_id", "p.*", F.lit(1.0).alias("iou")
    )
    return _patches(ds.with_run("eval", pairs.filter("pred_id IS NOT NULL AND truth_id IS NOT NULL")))
