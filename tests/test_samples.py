"""Stages that keep or drop samples, and the order stages."""

import pytest
from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.plans import ranking

from .conftest import dataset, id_set, ids


def test_match(ten):
    assert len(ids(sc.match(ten, "category = 'blue'"))) == 4
    assert len(ids(sc.match(ten, F.col("category") == "blue"))) == 4


def test_match_rejects_what_is_no_predicate(ten):
    with pytest.raises(ValueError):
        sc.match(ten, 3)


def test_exists(ten, labelled):
    assert len(ids(sc.exists(ten, "score"))) == 10
    assert id_set(sc.exists(labelled, "animals")) == {"a", "b", "c", "e"}
    assert id_set(sc.exists(labelled, "animals", bool=False)) == {"d"}
    with pytest.raises(sc.FieldNotFound):
        sc.exists(ten, "nothing")


def test_match_tags(ten, labelled):
    assert len(ids(sc.match_tags(ten, ["test"]))) == 3
    assert id_set(sc.match_tags(labelled, "x")) == {"a", "e"}
    assert id_set(sc.match_tags(labelled, ["x", "y"], all=True)) == {"e"}
    assert id_set(sc.match_tags(labelled, ["x", "y"], bool=False)) == {"b", "c"}
    assert id_set(sc.match_tags(labelled, ["y", "y"], all=True)) == {"d", "e"}


def test_match_labels_treats_null_as_no_match(labelled):
    dog = "l.label = 'dog'"
    assert id_set(sc.match_labels(labelled, dog, fields="animals")) == {"a", "e"}
    assert id_set(sc.match_labels(labelled, dog, fields="animals", bool=False)) == {"b", "c", "d"}
    anything = sc.match_labels(labelled, "l.label IN ('dog', 'bus')")
    assert id_set(anything) == {"a", "d", "e"}


def test_filter_field(ten):
    assert len(ids(sc.filter_field(ten, "score", "score > 5"))) == 5
    kept = sc.filter_field(ten, "score", "score > 5", only_matches=False)
    assert kept.df.filter("score IS NULL").count() == 5


def test_select(ten):
    assert ids(sc.select(ten, ["s5", "s1", "nobody", "s5"])) == ["s1", "s5"]
    assert ids(sc.select(ten, ["s5", "s1", "nobody", "s5"], ordered=True)) == ["s5", "s1"]
    assert ids(sc.select(ten, [])) == []
    assert ids(sc.select(ten, "s3")) == ["s3"]


def test_select_long_lists_join(ten, monkeypatch):
    monkeypatch.setattr("samplecraft.operators.samples.INLINE_VALUES", 1)
    assert ids(sc.select(ten, ["s5", "s1", "s5"])) == ["s1", "s5"]


def test_select_by_table_needs_positions_for_order(spark, ten):
    wanted = spark.createDataFrame([("s7",), ("s2",)], "id string")
    assert ids(sc.select(ten, wanted)) == ["s2", "s7"]
    with pytest.raises(ValueError, match="position"):
        sc.select(ten, wanted, ordered=True)
    placed = spark.createDataFrame([("s7", 0), ("s2", 1)], "id string, position int")
    assert ids(sc.select(ten, placed, ordered=True)) == ["s7", "s2"]


def test_select_by(ten):
    assert ids(sc.select_by(ten, "category", ["red", "green"])) == ["s0", "s3", "s4", "s6", "s7", "s8"]
    ordered = sc.select_by(ten, "category", ["red", "green"], ordered=True)
    assert ids(ordered) == ["s0", "s4", "s8", "s3", "s6", "s7"]


def test_select_group_slices(spark):
    rows = [("1", "g", "left", "image"), ("2", "g", "right", "image"), ("3", "h", "left", "video")]
    ds = dataset(spark, rows, "sample_id string, group_id string, slice string, media_type string")
    assert ids(sc.select_group_slices(ds)) == ["1", "2", "3"]
    assert ids(sc.select_group_slices(ds, slices="left")) == ["1", "3"]
    assert ids(sc.select_group_slices(ds, slices=["left"], media_type="image")) == ["1"]


def test_filter_view(ten):
    view = sc.filter_view(
        ten, filters={"category": "blue"}, match="score < 5", exists="score", tags="train",
        sample_ids=["s1", "s2", "s5", "s9"], limit=1,
    )
    assert ids(view) == ["s1"]


def test_filter_view_none_matches_null(labelled):
    assert id_set(sc.filter_view(labelled, filters={"tags": None})) == {"c"}


# -- order ---------------------------------------------------------------------------


def test_sort_by(ten):
    view = sc.sort_by(ten, "score", reverse=True)
    assert ids(view)[:3] == ["s4", "s6", "s2"]
    assert ids(sc.sort_by(ten, "-score"))[:3] == ["s4", "s6", "s2"]
    assert view.rows().columns == ten.rows().columns


def test_reverse_reads_the_order_backwards(ten):
    forward = ids(sc.sort_by(ten, "category"))
    assert ids(sc.sort_by(ten, "category", reverse=True)) == forward[::-1]


def test_nulls_first_ascending(spark):
    ds = dataset(spark, [("a", 1.0), ("b", None), ("c", float("nan"))], "sample_id string, v double")
    assert ids(sc.sort_by(ds, "v")) == ["b", "a", "c"]
    assert ids(sc.skip(sc.sort_by(ds, "v"), 1)) == ["a", "c"]
    assert ids(sc.limit(sc.sort_by(ds, "v", reverse=True), 2)) == ["c", "a"]


def test_chain(ten):
    view = sc.limit(sc.sort_by(sc.match(ten, "score > 5"), "score", reverse=True), 2)
    assert [r.score for r in view.sorted_rows().collect()] == [9.5, 8.0]


@pytest.mark.parametrize("topk_rows, topk_keys", [(1_000, 100_000), (0, 100_000), (0, 0)])
@pytest.mark.parametrize("n", [0, 1, 5, 10, 25])
@pytest.mark.parametrize("reverse", [False, True])
def test_limit_and_skip_cut_at_the_same_place(ten, monkeypatch, topk_rows, topk_keys, n, reverse):
    monkeypatch.setattr(ranking, "TOPK_ROWS", topk_rows)
    monkeypatch.setattr(ranking, "TOPK_KEYS", topk_keys)
    view = sc.sort_by(ten, "category", reverse=reverse)
    whole = ids(view)
    assert ids(sc.limit(view, n)) == whole[:n]
    assert ids(sc.skip(view, n)) == whole[n:]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_positions_do_not_depend_on_partitions(spark, partitions):
    rows = [(f"s{i:03}", ["hot", "hot", "cold"][i % 3]) for i in range(300)]
    ds = dataset(spark, rows, "sample_id string, kind string", partitions)
    placed = sc.with_position(sc.sort_by(ds, "kind")).collect()
    expected = sorted(rows, key=lambda r: (r[1], r[0]))
    assert sorted((r.position, r.sample_id) for r in placed) == [
        (i, r[0]) for i, r in enumerate(expected)
    ]


def test_page(ten, monkeypatch):
    assert ids(sc.page(ten, 4, 3)) == ["s4", "s5", "s6"]
    assert ids(sc.page(ten, 8, 5)) == ["s8", "s9"]
    monkeypatch.setattr(ranking, "TOPK_ROWS", 2)
    assert ids(sc.page(ten, 4, 3)) == ["s4", "s5", "s6"]


def test_take(ten):
    drawn = sc.take(ten, 5, seed=1)
    assert len(ids(drawn)) == 5
    assert ids(drawn) == ids(sc.take(ten, 5, seed=1)) == sorted(ids(drawn))
    assert len(ids(sc.take(ten, 50))) == 10
    draws = {tuple(ids(sc.take(ten, 5, seed=s))) for s in range(5)}
    assert len(draws) > 1


def test_shuffle(ten):
    mixed = ids(sc.shuffle(ten, seed=3))
    assert sorted(mixed) == ids(ten) and mixed != ids(ten)
    assert mixed == ids(sc.shuffle(ten, seed=3))
    assert len(ids(sc.shuffle(ten))) == 10


def test_take_after_shuffle_keeps_the_shuffled_order(ten):
    mixed = sc.shuffle(ten, seed=3)
    drawn = ids(sc.take(mixed, 4, seed=9))
    assert drawn == [i for i in ids(mixed) if i in drawn]


def test_group_by(ten):
    groups = {r.key: (r.n, r.first_id) for r in sc.group_by(ten, "category").df.collect()}
    assert groups == {"red": (3, "s0"), "blue": (4, "s1"), "green": (3, "s3")}
    last = sc.group_by(sc.sort_by(ten, "score", reverse=True), "category").df.collect()
    assert {r.key: r.first_id for r in last} == {"red": "s4", "blue": "s2", "green": "s6"}


def test_group_members(ten):
    assert ids(sc.group_members(ten, "category"))[:3] == ["s1", "s2", "s5"]
    by_score = sc.group_members(sc.sort_by(ten, "-score"), "category")
    assert ids(by_score)[:3] == ["s2", "s9", "s5"]


# -- specs ---------------------------------------------------------------------------


def test_specs(ten):
    view = sc.apply_stages(
        ten,
        [
            {"type": "Match", "filter": "score > 5"},
            {"type": "SortBy", "field_or_expr": "score", "reverse": True},
            {"type": "Limit", "limit": 2},
        ],
    )
    assert ids(view) == ["s4", "s6"]
    assert ids(sc.apply_stages(ten, [])) == ids(ten)


@pytest.mark.parametrize(
    "spec, message",
    [
        ({"type": "Nope"}, "stage 1: unknown type 'Nope'"),
        ({}, "stage 1: unknown type ''"),
        ({"type": "Limit"}, r"stage 1 \(Limit\)"),
        ({"type": "Limit", "limit": 1, "more": 2}, r"stage 1 \(Limit\)"),
        ({"type": "Exists", "field": "nothing"}, r"stage 1 \(Exists\)"),
        ({"type": "Match", "filter": "score >"}, r"stage 1 \(Match\)"),
        ({"type": "Match", "filter": "__import__('os')"}, r"stage 1 \(Match\)"),
    ],
)
def test_bad_specs_name_the_stage(ten, spec, message):
    with pytest.raises(ValueError, match=message):
        sc.apply_stages(ten, [{"type": "Skip", "skip": 1}, spec])


def test_every_stage_has_a_spec_name():
    from samplecraft.operators.stages import _stage_functions

    assert len(_stage_functions()) == 23


@pytest.mark.parametrize("topk_keys", [50, 10_000])
@pytest.mark.parametrize("key", ["id", "id div 2", "7", "if(id < 700, 5, id)"])
def test_counts_are_exact_with_repeated_ids(spark, monkeypatch, topk_keys, key):
    monkeypatch.setattr(ranking, "TOPK_ROWS", 10)
    monkeypatch.setattr(ranking, "TOPK_KEYS", topk_keys)
    ds = sc.Dataset(spark.range(2000, numPartitions=5).selectExpr(f"{key} AS sample_id", "id AS v"))
    everything = sorted(r.sample_id for r in ds.df.collect())
    for n in (0, 9, 11, 701, 1501, 1999, 2000, 2500):
        first, rest = sc.limit(ds, n), sc.skip(ds, n)
        assert sorted(r.sample_id for r in first.df.collect()) == everything[:n]
        assert sorted(r.sample_id for r in rest.df.collect()) == everything[n:]
    assert sc.take(ds, 1501, seed=1).df.count() == 1501
    assert sc.get_values(ds, "v", limit=1501).filter("truncated").count() == 1501
    assert sc.get_values(ds, "v", limit=2000).filter("NOT truncated").count() == 2000


def test_positions_need_unique_ids(spark):
    ds = sc.Dataset(spark.range(10).selectExpr("id div 2 AS sample_id"))
    with pytest.raises(ValueError, match="repeat"):
        sc.with_position(ds)


def test_a_facet_without_a_condition_does_not_filter(ten, labelled):
    for state in ({}, {"exclude": True}, {"values": []}, {"none": False}):
        assert sc.facet_filter(ten, {"score": state}).df.count() == 10
        assert sc.facet_filter(labelled, {"animals.label": {**state, "isMatching": True}}).df.count() == 5
