import numpy as np
import pytest

import samplecraft as sc

from .conftest import dataset

BOX = "array<struct<id:string,label:string,confidence:double,box:array<double>>>"


def guesses(spark):
    rows = [
        ("a", "cat", "cat", "x"), ("b", "cat", "dog", "x"), ("c", "dog", "dog", "y"),
        ("d", "dog", "dog", None), ("e", None, "cat", "y"), ("f", None, None, "y"),
    ]
    return dataset(spark, rows, "sample_id string, truth string, pred string, part string")


def test_classification(spark):
    matches = sc.evaluate_classification(guesses(spark), "pred", "truth")
    assert {r.sample_id for r in matches.collect() if r.correct} == {"a", "c", "d", "f"}
    counts = {(r.truth, r.pred): r.n for r in sc.confusion_counts(matches).collect()}
    assert counts == {
        ("cat", "cat"): 1, ("cat", "dog"): 1, ("dog", "dog"): 2, (None, "cat"): 1, (None, None): 1
    }
    assert sc.accuracy(matches).first() == (6, 4, 4 / 6)
    report = {r["class"]: r for r in sc.classification_report(matches).collect()}
    assert (report["cat"].tp, report["cat"].fp, report["cat"].fn) == (1, 1, 1)
    assert (report["dog"].precision, report["dog"].recall) == (2 / 3, 1.0)
    assert report["cat"].f1 == 0.5 and report[None].recall == 0.5
    assert sc.accuracy(matches.limit(0)).first() == (0, 0, None)


def test_slices(spark):
    rows = sc.evaluate_by_slice(guesses(spark), "pred", "truth", "part").collect()
    accuracy = {(r.overall, r.slice): r.accuracy for r in rows}
    assert accuracy == {
        (False, "x"): 0.5, (False, "y"): 2 / 3, (False, None): 1.0, (True, "(all)"): 4 / 6
    }
    named = {"with_part": "part IS NOT NULL", "x": "part = 'x'", "nobody": "part = 'z'"}
    rows = sc.evaluate_by_slice(guesses(spark), "pred", "truth", named).collect()
    accuracy = {r.slice: r.accuracy for r in rows}
    assert accuracy == {"with_part": 3 / 5, "x": 0.5, "(all)": 4 / 6}


# -- detections ----------------------------------------------------------------------


def iou(a, b):
    w = max(min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), 0.0)
    h = max(min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]), 0.0)
    union = a[2] * a[3] + b[2] * b[3] - w * h
    return w * h / union if union else 0.0


def greedy(preds, truths, least, classwise):
    pairs, used = [], set()
    for p in sorted(preds, key=lambda p: (p[2] is None, -(p[2] or 0), p[0])):
        options = [
            (-iou(p[3], t[3]), t[0])
            for t in truths
            if t[0] not in used and (not classwise or t[1] == p[1]) and iou(p[3], t[3]) >= least
        ]
        if options:
            down, best = min(options)
            used.add(best)
            pairs.append((p[0], best, -down))
    return pairs


def boxes(random, prefix, n):
    return [
        (
            f"{prefix}{i}", "ab"[random.integers(2)],
            None if random.random() < 0.1 else float(random.integers(1, 6)) / 5,
            [float(x) for x in random.integers(0, 4, 2) / 4] + [1.0, 1.0],
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def scenes(spark):
    random = np.random.default_rng(5)
    rows = [
        (f"s{i}", boxes(random, "p", random.integers(0, 7)), boxes(random, "t", random.integers(0, 7)))
        for i in range(60)
    ]
    rows += [("none", None, None), ("empty", [], [])]
    ds = dataset(
        spark, rows, f"sample_id string, predictions {BOX}, ground_truth {BOX}", partitions=3
    )
    return ds, rows


@pytest.mark.parametrize("least", [0.3, 0.5, 1.0])
@pytest.mark.parametrize("classwise", [True, False])
def test_matching_is_greedy(scenes, least, classwise):
    ds, rows = scenes
    matches = sc.evaluate_detections(ds, "predictions", "ground_truth", least, classwise)
    got = {(r.sample_id, r.pred_id, r.truth_id): r.iou for r in matches.collect()}
    expected = {
        (sample, p, t): overlap
        for sample, preds, truths in rows
        for p, t, overlap in greedy(preds or [], truths or [], least, classwise)
    }
    assert got.keys() == expected.keys()
    for key, overlap in expected.items():
        assert got[key] == pytest.approx(overlap)


def test_patches_account_for_every_label(scenes):
    ds, rows = scenes
    ds = ds.with_run("eval", sc.evaluate_detections(ds, "predictions", "ground_truth"))
    patches = sc.to_evaluation_patches(ds, "eval")
    kinds = {r.type: r["count"] for r in patches.df.groupBy("type").count().collect()}
    assert kinds["tp"] + kinds["fp"] == sum(len(p or []) for _, p, _ in rows)
    assert kinds["tp"] + kinds["fn"] == sum(len(t or []) for _, _, t in rows)
    assert patches.df.select("patch_id").distinct().count() == patches.df.count()
    report = sc.detection_report(ds, "predictions", "ground_truth").collect()
    for kind in ("tp", "fp", "fn"):
        assert sum(r[kind] for r in report) == kinds[kind]
    with pytest.raises(ValueError, match="no evaluation 'other'"):
        sc.to_evaluation_patches(ds, "other")
    stages = [{"type": "ToEvaluationPatches", "eval_key": "eval"}, {"type": "Match", "filter": "type = 'fn'"}]
    assert sc.apply_stages(ds, stages).df.count() == kinds["fn"]


def test_detections_need_label_lists(ten):
    with pytest.raises(ValueError, match="not a list of labels"):
        sc.evaluate_detections(ten, "tags", "tags")


def test_one_crowded_sample(spark):
    random = np.random.default_rng(1)
    def crowd(prefix):
        return [(f"{prefix}{i}", "c", float(random.random()), [float(x) for x in random.random(2) * 40] + [1.0, 1.0]) for i in range(1600)]
    rows = [("one", crowd("p"), crowd("t"))]
    ds = dataset(spark, rows, f"sample_id string, predictions {BOX}, ground_truth {BOX}")
    got = {(r.pred_id, r.truth_id) for r in sc.evaluate_detections(ds, "predictions", "ground_truth", 0.3).collect()}
    assert got == {(p, t) for p, t, _ in greedy(rows[0][1], rows[0][2], 0.3, True)}


def test_a_stored_run_survives_a_reload(scenes, tmp_path):
    ds, _ = scenes
    joined = ds.with_run("eval", sc.evaluate_detections(ds, "predictions", "ground_truth"))
    expected = sorted(map(str, sc.to_evaluation_patches(joined, "eval").rows().collect()))
    stored = sc.store_evaluation(ds, "eval")
    assert sorted(map(str, sc.to_evaluation_patches(stored, "eval").rows().collect())) == expected
    again = sc.clone_dataset(stored, str(tmp_path / "copy"))
    assert sorted(map(str, sc.to_evaluation_patches(again, "eval").rows().collect())) == expected
    assert "_run_eval" not in again.rows().columns
    with pytest.raises(ValueError, match="have: eval"):
        sc.to_evaluation_patches(again, "other")
