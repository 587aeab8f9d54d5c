import re

import pytest
from pyspark.sql import functions as F

import samplecraft as sc
from samplecraft.operators import schema
from samplecraft.plans.staging import new_path

from .conftest import dataset, ids


@pytest.fixture(scope="module")
def six(spark):
    rows = [(f"s{i}", i, f"image_{i}.jpg", [f"tag_{i % 2}"]) for i in range(6)]
    return dataset(
        spark, rows, "sample_id string, ord long, filepath string, tags array<string>", order=("ord",)
    )


def count(change):
    return change.count().first().n


def tags(ds):
    return {r.sample_id: r.tags for r in ds.df.collect()}


def counts(ds):
    return {r.tag: r.n for r in sc.count_sample_tags(ds).collect()}


def test_count_sample_tags(six, labelled):
    assert counts(six) == {"tag_0": 3, "tag_1": 3}
    assert counts(labelled) == {"x": 2, "y": 2}


def test_tag_everybody(six):
    change = sc.tag_samples(six, ["new"])
    assert count(change) == 6 and counts(change.dataset)["new"] == 6


def test_tag_selection(six):
    assert count(sc.tag_samples(six, "new", sample_ids=["s0", "s1"])) == 2
    assert count(sc.tag_samples(six, "new", sample_ids=[])) == 0
    some = sc.match_tags(six, "tag_1")
    assert count(sc.tag_samples(six, "new", view=some)) == 3
    # ids win over the view, an empty list included
    assert count(sc.tag_samples(six, "new", view=some, sample_ids=["s0"])) == 1
    assert count(sc.tag_samples(six, "new", view=some, sample_ids=[])) == 0
    stages = [{"type": "MatchTags", "tags": "tag_0"}, {"type": "Limit", "limit": 2}]
    assert count(sc.tag_samples(six, "new", view=stages)) == 2


def test_filter_views_are_flagged_without_a_join(six):
    def plan(view):
        flagged = sc.tag_samples(six, "new", view=view).dataset.df
        return flagged._jdf.queryExecution().executedPlan().toString()

    chain = [{"type": "MatchTags", "tags": "tag_1"}, {"type": "Match", "filter": "ord > 1"}]
    assert "Join" not in plan(chain) and "Join" not in plan(sc.match(six, "ord > 1"))
    assert count(sc.tag_samples(six, "new", view=chain)) == 2
    assert "Join" in plan(sc.limit(six, 2))
    nulls = sc.match(six, "nullif(ord, 1) > 0")
    assert count(sc.tag_samples(six, "new", view=nulls)) == 4


def test_a_bad_view_tags_nobody(six):
    with pytest.raises(ValueError):
        sc.tag_samples(six, "new", view=[{"type": "Match", "filter": "nothing = 1"}])


def test_tags_are_a_set_and_tagged_samples_count(six):
    change = sc.tag_samples(six, ["tag_0", "tag_0"])
    assert count(change) == 6
    assert tags(change.dataset)["s0"] == ["tag_0"]
    assert tags(change.dataset)["s1"] == ["tag_1", "tag_0"]


def test_tagging_null_tags(labelled):
    tagged = tags(sc.tag_samples(labelled, "new").dataset)
    assert tagged["c"] == ["new"] and tagged["b"] == ["new"]


def test_untag(six, labelled):
    change = sc.untag_samples(six, "tag_0")
    assert count(change) == 6 and counts(change.dataset) == {"tag_1": 3}
    left = tags(sc.untag_samples(labelled, ["x"]).dataset)
    assert left == {"a": [], "b": [], "c": None, "d": ["y", "y"], "e": ["y"]}


def test_tag_and_untag_cancel(six):
    there = sc.tag_samples(six, "fresh", sample_ids=["s2", "s3"]).dataset
    assert tags(sc.untag_samples(there, "fresh").dataset) == tags(six)


def test_long_id_lists_join(six, monkeypatch):
    monkeypatch.setattr("samplecraft.operators.samples.INLINE_VALUES", 1)
    assert count(sc.tag_samples(six, "new", sample_ids=["s0", "s1", "s0"])) == 2


def test_write_counts_in_the_same_job(spark, six):
    path = new_path(spark, "tagged")
    assert sc.tag_samples(six, "new", sample_ids=["s0", "s1"]).write(path) == 2
    again = sc.import_samples(spark, path)
    assert again.order == ("ord",) and counts(again)["new"] == 2
    assert "_touched" not in again.df.columns


# -- values --------------------------------------------------------------------------


def values(change, field):
    return [r[field] for r in change.dataset.sorted_rows().collect()]


def test_set_values_by_id(six):
    change = sc.set_values(six, "score", {"s1": 0.5, "s4": None, "ghost": 1.0})
    assert values(change, "score") == [None, 0.5, None, None, None, None]
    assert count(change) == 1


def test_set_values_drops_or_keeps_the_unmatched(six):
    assert values(sc.set_values(six, "ord", {"s1": 10}), "ord") == [None] * 5 + [10]
    kept = sc.set_values(six, "ord", {"s1": 10, "s2": None}, keep_unmatched=True)
    assert sorted(values(kept, "ord"), key=str) == sorted([0, 10, None, 3, 4, 5], key=str)


def test_set_values_by_list(six):
    given = [0.1 * i for i in range(6)]
    change = sc.set_values(six, "score", given)
    assert values(change, "score") == given and count(change) == 6
    with pytest.raises(ValueError, match="2 values for 6 samples"):
        sc.set_values(six, "score", [1.0, 2.0])


def test_set_values_by_another_key(six):
    change = sc.set_values(six, "score", {"image_2.jpg": 7}, key_field="filepath")
    assert values(change, "score") == [None, None, 7, None, None, None]


def test_set_values_by_table(spark, six):
    table = spark.createDataFrame([("s1", "a"), ("s2", "b")], "id string, v string")
    assert values(sc.set_values(six, "note", table), "note")[:3] == [None, "a", "b"]
    twice = table.union(table)
    with pytest.raises(Exception, match="more than one value"):
        sc.set_values(six, "note", twice).dataset.df.collect()


def test_set_nested_values(spark):
    ds = dataset(spark, [("a", (1, 2)), ("b", (3, 4))], "sample_id string, p struct<x:long,y:long>")
    change = sc.set_values(ds, "p.x", {"a": 9}, keep_unmatched=True)
    assert values(change, "p") == [(9, 2), (3, 4)]


def test_remap_and_clone(six, monkeypatch):
    mapping = {"image_0.jpg": "a", "image_1.jpg": "b"}
    named = sc.remap_values(six, "filepath", mapping)
    assert [r.filepath for r in named.sorted_rows().collect()][:3] == ["a", "b", "image_2.jpg"]
    monkeypatch.setattr("samplecraft.operators.mutations.INLINE_VALUES", 1)
    joined = sc.remap_values(six, "filepath", mapping)
    assert joined.sorted_rows().collect() == named.sorted_rows().collect()
    copied = sc.clone_field(six, "ord", "place")
    assert copied.df.filter("ord = place").count() == 6
    with pytest.raises(ValueError):
        sc.clone_field(six, "ord", "tags")


# -- samples -------------------------------------------------------------------------


def test_add_samples(six):
    change = sc.add_samples(
        six, [{"filepath": "x.jpg", "score": 0.5}, {"filepath": "x.jpg", "tags": ["new"]}], "batch"
    )
    grown = change.dataset
    assert count(change) == 2 and grown.df.count() == 8
    assert {r.sample_id for r in change.ids().collect()} == set(ids(grown)[6:])
    assert len(set(ids(grown))) == 8 and ids(grown)[:6] == ids(six)
    assert [r.score for r in grown.sorted_rows().collect()][6:] == [0.5, None]
    again = sc.add_samples(six, [{"filepath": "x.jpg"}, {"filepath": "x.jpg"}], "batch").dataset
    assert ids(again) == ids(grown)


@pytest.mark.parametrize("bad", [{}, {"filepath": ""}, {"filepath": None}])
def test_every_sample_needs_a_filepath(spark, six, bad):
    with pytest.raises(ValueError, match="filepath"):
        sc.add_samples(six, [{"filepath": "x.jpg"}, bad], "batch")
    table = spark.createDataFrame([(0, bad.get("filepath"))], "position long, filepath string")
    with pytest.raises(ValueError, match="filepath"):
        sc.add_samples(six, table, "batch")


@pytest.mark.parametrize("inline", [1, 1_000])
def test_short_and_long_key_lists_are_alike(spark, monkeypatch, inline):
    for module in ("samples", "mutations"):
        monkeypatch.setattr(f"samplecraft.operators.{module}.INLINE_VALUES", inline)
    rows = [("a", 1, "x"), ("b", 2, None), ("c", None, "z"), ("7", 7, "x")]
    ds = dataset(spark, rows, "sample_id string, n long, s string", 2)
    assert {r.sample_id for r in sc.select_by(ds, "n", [1, 2, None, 9]).df.collect()} == {"a", "b"}
    assert {r.sample_id for r in sc.select(ds, ["a", 7, None]).df.collect()} == {"a", "7"}
    for wrong in (["5", "6"], [1.5, 2], [2**70, 1]):
        with pytest.raises(ValueError, match="type bigint"):
            sc.select_by(ds, "n", wrong)
    change = sc.tag_samples(ds, "t", sample_ids=["a", None, 7])
    assert count(change) == 2 and count(sc.untag_samples(ds, "t", sample_ids=["a", 7])) == 2
    mapped = sc.remap_values(ds, "s", {"x": "y", None: "none", "z": None, "q": "r"})
    assert {r.sample_id: r.s for r in mapped.df.collect()} == {"a": "y", "b": "none", "c": None, "7": "y"}
    assert {r.n for r in sc.remap_values(ds, "n", {1: 10, 2: 20}).df.collect()} == {10, 20, None, 7}
    with pytest.raises(ValueError, match="type bigint"):
        sc.remap_values(ds, "n", {"1": 2, "3": 4})
    numbers = dataset(spark, [("1",), ("2",)], "sample_id string")
    set_ = sc.set_values(numbers, "v", {1: "first", "1": "last", None: "x"}).dataset.df.collect()
    assert {r.sample_id: r.v for r in set_} == {"1": "last", "2": None}


def test_a_dataset_without_tags_can_be_tagged(spark):
    ds = dataset(spark, [("a",), ("b",)], "sample_id string")
    tagged = sc.tag_samples(ds, "new", sample_ids=["b"]).dataset
    assert {r.sample_id: r.tags for r in tagged.df.collect()} == {"a": None, "b": ["new"]}
    assert sc.untag_samples(ds, "new").dataset.df.filter("tags IS NOT NULL").count() == 0
    assert sc.count_sample_tags(ds).count() == 0


@pytest.mark.parametrize(
    "kind, values",
    [
        ("int", [5, 1, 9]), ("double", [0.5, -1.0, 2.5]), ("string", ["b", "a", "zz"]),
        ("timestamp", ["2024-01-01 00:00:00", "2025-06-01 12:00:00", "2023-01-01 00:00:00"]),
        ("date", ["2024-01-01", "2025-06-01", "2023-01-01"]), ("decimal(10,2)", ["1.5", "7.25", "3"]),
    ],
)
@pytest.mark.parametrize("reverse", [False, True])
def test_added_samples_are_last(spark, kind, values, reverse):
    rows = [(f"s{i}", f"f{i}", str(v)) for i, v in enumerate(values)]
    base = spark.createDataFrame(rows, "sample_id string, filepath string, n string")
    ds = sc.Dataset(base.withColumn("n", base.n.cast(kind)), order=("n",), reverse=reverse)
    new = [{"filepath": f"new{i}"} for i in range(12)]
    if kind == "string" and reverse:
        with pytest.raises(ValueError, match="give its values"):
            sc.add_samples(ds, new, "batch")
        return
    grown = sc.add_samples(ds, new, "batch").dataset
    assert [r.filepath for r in grown.sorted_rows().collect()][3:] == [s["filepath"] for s in new]


def test_added_samples_by_two_order_fields(spark):
    ds = dataset(spark, [("a", "f", 3, 1), ("b", "g", 3, 2)], "sample_id string, filepath string, x long, y long", order=("x", "y"))
    grown = sc.add_samples(ds, [{"filepath": "one"}, {"filepath": "two"}], "batch").dataset
    assert [r.filepath for r in grown.sorted_rows().collect()] == ["f", "g", "one", "two"]


def test_inferred_fields_by_type_and_not_by_text(spark):
    texts = ['{"VOID": 1, "DECIMAL(3,1)": 2.5, "VARIANT": {"OBJECT<": [1, 2], "a: b": "x", "q`t": true}}', "[1, 2]", "no json", "3", None, '{"mix": 1}', '{"mix": "t"}']
    ds = dataset(spark, [(i, t) for i, t in enumerate(texts)], "sample_id long, doc string")
    rows = [r.doc for r in sc.infer_fields(ds, "doc").df.orderBy("sample_id").collect()]
    assert rows[0]["VOID"] == 1 and rows[0]["DECIMAL(3,1)"] == 2.5
    assert rows[0]["VARIANT"]["OBJECT<"] == [1, 2] and rows[0]["VARIANT"]["a: b"] == "x" and rows[0]["VARIANT"]["q`t"] is True
    assert rows[1:5] == [None] * 4 or all(r is None or all(v is None for v in r) for r in rows[1:5])
    assert [r["mix"] for r in rows[5:]] == ["1", "t"]
    with pytest.raises(ValueError, match="no|not hold"):
        sc.infer_fields(dataset(spark, [(0, "[1]")], "sample_id long, doc string"), "doc")
    wide = dataset(spark, [(i, f'{{"user{i}": 1}}') for i in range(300)], "sample_id long, doc string")
    with pytest.raises(ValueError, match="more than 100"):
        sc.infer_fields(wide, "doc", max_fields=100)


@pytest.mark.parametrize("text", ['{{"a": {{"user{0}": 1}}}}', '{{"a": [[{{"b": {{"user{0}": []}}}}]]}}'])
def test_inferred_maps_below_raise_before_their_schema_is_merged(spark, text):
    deep = dataset(spark, [(i, text.format(i)) for i in range(3_000)], "sample_id long, doc string")
    with pytest.raises(ValueError, match="more than 500"):
        sc.infer_fields(deep, "doc", max_fields=500)


def test_a_profile_stops_at_its_limit():
    read = []

    def schemas():
        for i in range(100_000):
            read.append(i)
            yield f"OBJECT<user{i}: OBJECT<n: BIGINT>>"

    assert len({p for p, _ in schema._profiled(schemas(), 40) if p}) == 41
    assert len(read) < 50


def test_inferred_fields_are_those_of_the_aggregate(spark):
    values = ["1", "2.5", "1e300", '"t"', "true", "null", "[]", "[1, 2.5]", "[[1], null]", '["t", 1]', '{"k": 1}', '{"k": [null]}', "{}"]
    texts = [f'{{"v{i}_{j}": {v}}}' for i, a in enumerate(values) for j, b in enumerate(values) for v in (a, b)]
    ds = dataset(spark, list(enumerate(texts)), "sample_id long, doc string")
    got = sc.infer_fields(ds, "doc").df.schema["doc"].dataType
    text = ds.df.select(F.schema_of_variant_agg(F.try_parse_json("doc"))).first()[0]
    for field in got:
        i, j = field.name[1:].split("_")
        found = re.search(rf"\b{field.name}: (.*?)(, v\d|>$)", text)[1]
        simple = re.sub(r"DECIMAL\(\d+,\d+\)|FLOAT", "DOUBLE", found)
        simple = re.sub(r"VOID|VARIANT", "STRING", simple)
        assert field.dataType.simpleString().upper().replace("STRUCT<", "OBJECT<").replace(":", ": ").replace(",", ", ").replace("K: ", "k: ") == simple, (values[int(i)], values[int(j)])
    assert len(got) == len(values) ** 2
