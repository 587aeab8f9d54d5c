import datetime
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

import samplecraft as sc

from .conftest import dataset


KINDS = ["elm", "oak", "oak", "fir", "elm", "oak", "fir", "oak"]
HEIGHTS = [2.0, 5.5, 3.25, 9.0, 7.5, 4.25, 6.0, 11.5]


@pytest.fixture(scope="module")
def trees(spark):
    rows = [(f"s{i}", kind, height) for i, (kind, height) in enumerate(zip(KINDS, HEIGHTS))]
    return dataset(spark, rows, "sample_id string, kind string, height double")


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [("a", 1.0), ("b", None), ("c", float("nan")), ("d", 3.0), ("e", None)]
    return dataset(spark, rows, "sample_id string, v double")


@pytest.fixture(scope="module")
def empty(spark):
    return dataset(spark, [], "sample_id string, v double")


def test_count_values(trees):
    assert {r.value: r.n for r in sc.count_values(trees, "kind").collect()} == Counter(KINDS)
    assert sc.count_values_totals(trees, "kind").first().asDict() == {"total": 8, "num_values": 3}


def test_null_is_a_value(awkward):
    counts = [(r.value, r.n) for r in sc.count_values(awkward, "v").collect()]
    assert (None, 2) in counts and len(counts) == 4


def test_values_through_lists(labelled):
    counts = {r.value: r.n for r in sc.count_values(labelled, "animals.label").collect()}
    assert counts == {"cat": 2, "dog": 2, None: 1}
    tags = {r.value: r.n for r in sc.count_values(labelled, "animals.tags").collect()}
    assert tags == {"ok": 2, "bad": 2}


def test_distinct(trees, awkward):
    assert [r.value for r in sc.distinct(trees, "kind").collect()] == ["elm", "fir", "oak"]
    assert sc.distinct_count(trees, "kind").first()[0] == 3
    assert sc.distinct_count(awkward, "v").first()[0] == 3


def test_measures(trees):
    assert sc.bounds(trees, "height").first() == (2.0, 11.5)
    assert sc.mean(trees, "height").first()[0] == pytest.approx(statistics.fmean(HEIGHTS))
    assert sc.sum(trees, "height").first()[0] == pytest.approx(49.0)
    assert sc.std(trees, "height").first()[0] == pytest.approx(statistics.pstdev(HEIGHTS))
    assert sc.std(trees, "height", sample=True).first()[0] == pytest.approx(statistics.stdev(HEIGHTS))


def test_measures_ignore_null_and_nan(awkward):
    assert sc.bounds(awkward, "v").first() == (1.0, 3.0)
    assert sc.mean(awkward, "v").first()[0] == 2.0
    assert sc.sum(awkward, "v").first()[0] == 4.0
    assert sc.std(awkward, "v").first()[0] == 1.0


def test_measures_of_nothing(empty):
    assert sc.bounds(empty, "v").first() == (None, None)
    assert sc.mean(empty, "v").first()[0] is None
    assert sc.sum(empty, "v").first()[0] == 0.0
    assert sc.count_values_totals(empty, "v").first().asDict() == {"total": 0, "num_values": 0}


def test_view_stages(trees):
    stages = [{"type": "Match", "filter": "height > 5"}]
    counts = {r.value: r.n for r in sc.count_values(trees, "kind", stages).collect()}
    assert counts == {"oak": 2, "fir": 2, "elm": 1}


def test_missing_field(trees):
    for aggregate in (sc.count_values, sc.distinct, sc.bounds, sc.mean, sc.sum, sc.std,
                      sc.histogram_values, sc.get_values):
        with pytest.raises(sc.FieldNotFound):
            aggregate(trees, "nothing")


def histogram(ds, *args, **kwargs):
    rows = sorted(sc.histogram_values(ds, *args, **kwargs).collect())
    return [r.n for r in rows], rows


def test_histogram(trees):
    # bins of 2.375 from 2 on: 2 3.25 4.25 | 5.5 6 | 7.5 9 | 11.5
    counts, rows = histogram(trees, "height", bins=4)
    assert counts == [3, 2, 2, 1] and {r.other for r in rows} == {0}
    assert rows[0].lower == 2.0 and rows[-1].upper == pytest.approx(11.5)
    assert all(a.upper == pytest.approx(b.lower) for a, b in zip(rows, rows[1:]))
    assert len(histogram(trees, "height")[0]) == 50


def test_histogram_range(trees):
    counts, rows = histogram(trees, "height", bins=10, value_range=[0, 20])
    assert sum(counts) == 8 and rows[0].other == 0
    counts, rows = histogram(trees, "height", bins=2, value_range=[3.25, 7.25])
    assert counts == [2, 2] and rows[0].other == 4  # 3.25 4.25 | 5.5 6


def test_histogram_edge_cases(awkward, empty, spark):
    counts, rows = histogram(awkward, "v", bins=3)
    assert counts == [1, 0, 1] and rows[0].other == 3
    assert sum(counts) + rows[0].other == 5
    assert histogram(awkward, "v", bins=1)[0] == [2]
    same = dataset(spark, [("a", 2.0), ("b", 2.0)], "sample_id string, v double")
    assert histogram(same, "v", bins=3)[0] == [2, 0, 0]
    assert histogram(empty, "v", bins=2)[0] == [0, 0]
    with pytest.raises(ValueError):
        sc.histogram_values(same, "v", bins=0)


def values(df):
    return [r.value for r in df.orderBy("position").collect()]


def test_get_values(trees):
    first = sc.get_values(trees, "kind", limit=3)
    assert values(first) == KINDS[:3]
    assert {r.truncated for r in first.collect()} == {True}
    assert {r.truncated for r in sc.get_values(trees, "kind", limit=8).collect()} == {False}
    everything = sc.get_values(trees, "height", limit=0)
    assert values(everything) == HEIGHTS
    assert {r.truncated for r in everything.collect()} == {False}


def test_get_values_beyond_the_default(spark):
    ds = sc.Dataset(spark.range(10_500).withColumnRenamed("id", "sample_id"))
    rows = sc.get_values(ds, "sample_id", limit=10_200)
    got = rows.agg(F.count("*"), F.max("position"), F.max("value"), F.every("truncated")).first()
    assert got == (10_200, 10_199, 10_199, True)
    assert sc.get_values(ds, "sample_id").count() == 10_000
    assert not sc.get_values(ds, "sample_id", limit=10_500).first().truncated


def test_get_values_keeps_lists(labelled):
    assert values(sc.get_values(labelled, "animals.label")) == [
        ["cat", "dog"], ["cat"], [], None, [None, "dog"]
    ]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_partitions_do_not_matter(spark, partitions):
    rows = [(f"s{i}", i % 7, float(i)) for i in range(200)]
    ds = dataset(spark, rows, "sample_id string, k int, v double", partitions)
    assert {r.value: r.n for r in sc.count_values(ds, "k").collect()} == {
        k: len(range(k, 200, 7)) for k in range(7)
    }
    assert histogram(ds, "v", bins=4)[0] == [50, 50, 50, 50]


NESTED = "sample_id string, x double, d date, name string, found array<struct<label:string,boxes:array<array<double>>>>, note struct<words:array<string>>"


def nested(spark):
    day = datetime.date(2024, 5, 1)
    rows = [
        ("a", 1.5, day, "n", [("cat", [[1.0, 2.0], None, []]), (None, None), None], (["x", None],)),
        ("b", None, None, None, [], None),
        ("c", float("nan"), day + datetime.timedelta(9), "m", None, ([],)),
        ("d", -4.0, day, "m", [("dog", [[7.0, None, float("nan")]])], (None,)),
    ]
    return dataset(spark, rows, NESTED)


@pytest.mark.parametrize("field", ["x", "d", "name", "found.label", "found.boxes", "note.words"])
def test_measures_are_those_of_single_functions(spark, field):
    ds = nested(spark)
    numeric = field in ("x", "found.boxes")
    wanted = {"b": ("bounds", field), "n": ("distinct_count", field), "c": ("count", field)}
    if numeric:
        wanted |= {"m": ("mean", field), "s": ("sum", field), "v": ("std", field)}
    row = sc.measures(ds, wanted | {"other": ("count", "name")}).first()
    assert row.b == sc.bounds(ds, field).first()
    assert row.n == sc.distinct_count(ds, field).first()[0]
    assert row.c == (sc.count_values_totals(ds, field).first().total)
    assert row.other == 4
    if numeric:
        assert (row.m, row.s, row.v) == (sc.mean(ds, field).first()[0], sc.sum(ds, field).first()[0], sc.std(ds, field).first()[0])


def test_measures_read_the_view_once(spark, tmp_path):
    nested(spark).df.write.parquet(str(tmp_path / "t"))
    ds = sc.Dataset(spark.read.parquet(str(tmp_path / "t")))
    stages = [{"type": "Match", "filter": "x > 0"}]
    found = sc.measures(ds, {"a": ("mean", "x"), "b": ("bounds", "d"), "c": ("sum", "x"), "e": ("std", "x"), "f": ("distinct_count", "found.label")}, stages)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert found.first().a == 1.5 and found.first().f == 1


def test_measures_of_nothing_and_of_wrong_names(spark):
    ds = nested(spark)
    none = ds.with_df(ds.df.limit(0))
    row = sc.measures(none, {"a": ("sum", "x"), "b": ("mean", "x"), "c": ("count", "found.label"), "d": ("bounds", "x")}).first()
    assert (row.a, row.b, row.c, tuple(row.d)) == (0.0, None, 0, (None, None))
    for wanted in ({}, {"a": ("median", "x")}, {"a": ("mean", "nope")}, {"a": ("mean", "found.nope")}):
        with pytest.raises(ValueError):
            sc.measures(ds, wanted)
