"""Evaluation of predictions against the truth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..dataset import Dataset, field_type, is_label_list, quoted, quoted_path, require_fields
from ..functions.predicates import sample_predicate
from ..plans.box_matching import PAIR, matches

DEFAULT_IOU = 0.5
RUN = "_run_"  # a stored run's private column is this and its key
OVERALL = "(all)"


# -- classification ------------------------------------------------------------------


def evaluate_classification(ds: Dataset, pred_field: str, truth_field: str) -> DataFrame:
    """The match table: ``sample_id, truth, pred, correct``, one row per sample.

    A null on either side is a class of its own: it equals only null [chosen].
    """
    require_fields(ds, [pred_field, truth_field])
    truth, pred = F.col(quoted_path(truth_field)), F.col(quoted_path(pred_field))
    return ds.df.select(
        F.col(quoted(ds.id_col)).alias("sample_id"),
        truth.alias("truth"),
        pred.alias("pred"),
        truth.eqNullSafe(pred).alias("correct"),
    )


def confusion_counts(matches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``truth, pred, n`` of a match table, per ``by`` columns if given."""
    return matches.groupBy(*(by or []), "truth", "pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy(matches: DataFrame) -> DataFrame:
    """One row ``n, correct, accuracy``; without samples the accuracy is null."""
    right = F.count_if("correct")
    n = F.count(F.lit(1))
    return matches.agg(
        n.alias("n"), right.alias("correct"), (right / F.nullif(n, F.lit(0))).alias("accuracy")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _scores(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per-class scores from confusion counts: each count adds to the class it was and
    to the class it was taken for."""
    hit = F.col("truth").eqNullSafe(F.col("pred"))
    zero = F.lit(0).cast("long")

    def role(cls: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(
            F.col(cls).alias("class"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn")
        )

    n = F.col("n")
    roles = F.array(
        role("truth", F.when(hit, n).otherwise(zero), zero, F.when(hit, zero).otherwise(n)),
        role("pred", zero, F.when(hit, zero).otherwise(n), zero),
    )
    per_class = (
        counts.select(*by, F.explode(roles).alias("r"))
        .select(*by, "r.*")
        .groupBy(*by, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return per_class.select(
        *by,
        "class",
        "tp",
        "fp",
        "fn",
        (tp + fn).alias("support"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(matches: DataFrame) -> DataFrame:
    """``class, tp, fp, fn, support, precision, recall, f1``; a score without any case
    is 0 [chosen]. Computed from the confusion counts, which are few."""
    return _scores(confusion_counts(matches), [])


def evaluate_by_slice(
    ds: Dataset,
    pred_field: str,
    truth_field: str,
    slices: str | Mapping[str, Column | str],
) -> DataFrame:
    """Per slice, and overall: the per-class scores and the slice's accuracy.

    ``slices`` is a field (one slice per value) or named predicates, which may overlap.
    The overall row has ``overall`` true and the slice name ``(all)``. Samples are
    counted once into (slice, truth, pred); everything else works on those counts.
    """
    require_fields(ds, [pred_field, truth_field])
    truth, pred = F.col(quoted_path(truth_field)), F.col(quoted_path(pred_field))
    if isinstance(slices, str):
        require_fields(ds, [slices])
        name = F.col(quoted_path(slices)).cast("string")
        base = ds.df.select(name.alias("slice"), truth.alias("truth"), pred.alias("pred"))
        whole = confusion_counts(base, ["slice"])
        mine = F.array(F.struct(F.lit(False).alias("overall"), F.col("slice").alias("slice")))
    else:
        # Bit i of the mask says whether the sample is in slice i: one pass for all.
        inside = [
            F.coalesce(sample_predicate(p), F.lit(False)).alias(f"s{i}")
            for i, p in enumerate(slices.values())
        ]
        masks = ds.df.select(F.array(*inside).alias("mask"), truth.alias("truth"), pred.alias("pred"))
        whole = confusion_counts(masks, ["mask"])
        names = F.lit(list(slices))
        held = F.filter(F.arrays_zip(names.alias("name"), F.col("mask")), lambda z: z["mask"])
        mine = F.transform(held, lambda z: F.struct(F.lit(False).alias("overall"), z["name"].alias("slice")))
    # The samples are aggregated once; every slice, and all together, add up its counts.
    every = F.array(F.struct(F.lit(True).alias("overall"), F.lit(OVERALL).alias("slice")))
    by = ["overall", "slice"]
    counts = whole.select(F.explode(F.concat(every, mine)).alias("s"), "truth", "pred", "n")
    counts = counts.groupBy("s.overall", "s.slice", "truth", "pred").agg(F.sum("n").alias("n"))
    scores = _scores(counts, by)
    # Each sample is in one class's support, and in its tp if it was right.
    whole_slice = Window.partitionBy(*by)
    accuracy = F.sum("tp").over(whole_slice) / F.sum("support").over(whole_slice)
    return scores.withColumn("accuracy", accuracy)


# -- detections ----------------------------------------------------------------------


def _with_matches(
    ds: Dataset, pred_field: str, truth_field: str, least_iou: float, classwise: bool
) -> DataFrame:
    """``sample_id``, both label lists and ``found``: the pairs, and which labels are in one.

    Predictions are taken by descending confidence, then id; each takes the free truth
    with the highest IoU, ties by id (Lin et al. 2014). Both lists are in the sample's
    row, so matching takes no join and no shuffle, and no pair leaves the row.
    """
    for name in (pred_field, truth_field):
        if not is_label_list(field_type(ds.df.schema, name)):
            raise ValueError(f"'{name}' is not a list of labels")
    preds, truths = F.col(quoted_path(pred_field)), F.col(quoted_path(truth_field))
    return ds.df.select(
        F.col(quoted(ds.id_col)).alias("sample_id"),
        F.coalesce(preds, F.array()).alias("preds"),
        F.coalesce(truths, F.array()).alias("truths"),
        # Null where one of the lists is empty.
        matches(preds, truths, least_iou, classwise).alias("found"),
    )


def evaluate_detections(
    ds: Dataset,
    pred_field: str,
    truth_field: str,
    iou: float = DEFAULT_IOU,
    classwise: bool = True,
) -> DataFrame:
    """The match table ``sample_id, pred_id, truth_id, iou`` of the matched pairs.

    Labels have ``id, label, confidence, box``; ids are unique within a sample. With
    ``classwise`` only labels of one class match.
    """
    matched = _with_matches(ds, pred_field, truth_field, iou, classwise)
    return matched.select("sample_id", F.explode("found.pairs").alias("p")).select(
        "sample_id", "p.pred_id", "p.truth_id", "p.iou"
    )


def store_evaluation(
    ds: Dataset,
    eval_key: str,
    pred_field: str = "predictions",
    truth_field: str = "ground_truth",
    iou: float = DEFAULT_IOU,
    classwise: bool = True,
) -> Dataset:
    """The dataset with an evaluation run under a key: each sample keeps its own matched
    pairs in a private column, which saves, loads and clones with the dataset."""
    _with_matches(ds, pred_field, truth_field, iou, classwise)  # checks the fields
    preds, truths = F.col(quoted_path(pred_field)), F.col(quoted_path(truth_field))
    none = F.array().cast(f"array<{PAIR}>")
    found = F.coalesce(matches(preds, truths, iou, classwise)["pairs"], none)
    column = found.alias(RUN + eval_key, metadata={"pred_field": pred_field, "truth_field": truth_field})
    kept = [quoted(c) for c in ds.df.columns if c != RUN + eval_key]
    return ds.with_df(ds.df.select(*kept, column))


def detection_report(
    ds: Dataset,
    pred_field: str,
    truth_field: str,
    iou: float = DEFAULT_IOU,
    classwise: bool = True,
) -> DataFrame:
    """``class, tp, fp, fn, precision, recall, f1`` of a detection evaluation.

    A prediction counts under its own class: as tp if matched, else as fp.
    """
    matched = _with_matches(ds, pred_field, truth_field, iou, classwise)

    def outcome(labels: str, flags: str, hit: str, miss: str) -> Column:
        none = F.array_repeat(F.lit(False), F.size(labels))
        return F.zip_with(
            labels,
            F.coalesce(F.col(f"found.{flags}"), none),
            lambda l, h: F.struct(l["label"].alias("class"), F.when(h, hit).otherwise(miss).alias("type")),
        )

    outcomes = F.concat(
        outcome("preds", "pred_hit", "tp", "fp"), outcome("truths", "truth_hit", "matched", "fn")
    )
    counts = (
        matched.select(F.explode(outcomes).alias("o"))
        .groupBy("o.class")
        .agg(*[F.count_if(F.col("o.type") == t).alias(t) for t in ("tp", "fp", "fn")])
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "class",
        "tp",
        "fp",
        "fn",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _stored_patches(ds: Dataset, eval_key: str, fields: dict[str, str]) -> DataFrame:
    """The patches of a stored run, out of each sample's own row."""
    pairs = F.col(quoted(RUN + eval_key))
    kind = "array<struct<type:string,pred_id:string,truth_id:string,iou:double>>"

    def part(type_: str, values: Column, pred: bool) -> Column:
        none = F.lit(None).cast("string")
        return F.transform(
            values,
            lambda i: F.struct(
                F.lit(type_).alias("type"),
                (i if pred else none).alias("pred_id"),
                (none if pred else i).alias("truth_id"),
                F.lit(None).cast("double").alias("iou"),
            ),
        )

    def left(name: str) -> Column:
        ids = F.col(quoted_path(fields[name]))["id"].cast("array<string>")
        return F.array_except(F.coalesce(ids, F.array().cast("array<string>")), pairs[f"{name}_id"])

    both = F.transform(
        pairs, lambda p: F.struct(F.lit("tp").alias("type"), p["pred_id"], p["truth_id"], p["iou"])
    )
    rows = F.concat(both.cast(kind), part("fp", left("pred"), True).cast(kind), part("fn", left("truth"), False).cast(kind))
    # A plain explode would also filter on the list's size, and so build it twice.
    exploded = ds.df.select(F.col(quoted(ds.id_col)).alias("sample_id"), F.explode_outer(rows).alias("r"))
    return exploded.filter("r IS NOT NULL").select("sample_id", "r.*")


def to_evaluation_patches(
    ds: Dataset,
    eval_key: str,
    pred_field: str | None = None,
    truth_field: str | None = None,
) -> Dataset:
    """One row per evaluation example of the run ``eval_key``: a matched pair (``tp``),
    an unmatched prediction (``fp``) or an unmatched truth (``fn``).

    Columns ``patch_id, sample_id, type, pred_id, truth_id, iou`` [chosen]. A run that
    :func:`store_evaluation` left in the dataset is read from each sample's own row. Any
    other is a table of matched pairs ``sample_id, pred_id, truth_id, iou`` attached with
    :meth:`Dataset.with_run`, and is joined. The label fields default to those of the
    stored run, else to ``predictions`` and ``ground_truth``.
    """
    stored = RUN + eval_key
    if stored not in ds.df.columns and eval_key not in ds.runs:
        known = [*ds.runs, *(c.removeprefix(RUN) for c in ds.df.columns if c.startswith(RUN))]
        raise ValueError(f"no evaluation '{eval_key}', have: {', '.join(known) or 'none'}")
    about = ds.df.schema[stored].metadata if stored in ds.df.columns else {}
    fields = {
        "pred": pred_field or about.get("pred_field", "predictions"),
        "truth": truth_field or about.get("truth_field", "ground_truth"),
    }
    require_fields(ds, list(fields.values()))
    if stored in ds.df.columns:
        return _as_patches(ds, _stored_patches(ds, eval_key, fields))

    def side(name: str) -> Column:
        ids = F.col(quoted_path(fields[name]))["id"]
        sided = F.transform(ids, lambda i: F.struct(F.lit(name).alias("side"), i.alias("id")))
        return F.coalesce(sided, F.array().cast("array<struct<side:string,id:string>>"))

    def link(name: str, other: str) -> Column:
        return F.struct(
            F.lit(name).alias("side"),
            F.col(f"{name}_id").alias("id"),
            F.col(f"{other}_id").alias("other"),
            "iou",
        )

    # All labels in one scan and one join: predictions keep their row either way, truths
    # only if nothing was matched to them.
    labels = ds.df.select(
        F.col(quoted(ds.id_col)).alias("sample_id"),
        F.explode(F.concat(side("pred"), side("truth"))).alias("l"),
    ).select("sample_id", "l.*")
    links = (
        ds.runs[eval_key]
        .filter("pred_id IS NOT NULL AND truth_id IS NOT NULL")
        .select("sample_id", F.explode(F.array(link("pred", "truth"), link("truth", "pred"))).alias("l"))
        .select("sample_id", "l.*")
    )
    rows = labels.join(links, ["sample_id", "side", "id"], "left")
    is_pred = F.col("side") == "pred"
    rows = rows.filter(is_pred | F.col("other").isNull())
    kind = F.when(~is_pred, "fn").when(F.col("other").isNull(), "fp").otherwise("tp")
    rows = rows.select(
        "sample_id",
        kind.alias("type"),
        F.when(is_pred, F.col("id")).alias("pred_id"),
        F.when(is_pred, F.col("other")).otherwise(F.col("id")).alias("truth_id"),
        "iou",
    )
    return _as_patches(ds, rows)


def _as_patches(ds: Dataset, rows: DataFrame) -> Dataset:
    name = F.concat_ws("/", "sample_id", "type", F.coalesce("pred_id", "truth_id"))
    patches = rows.select(name.alias("patch_id"), "sample_id", "type", "pred_id", "truth_id", "iou")
    return ds.with_df(patches, id_col="patch_id", order=("sample_id",), reverse=False, label_fields=())
