"""Schemas, summaries, names, import and export, issues."""

import collections
import datetime

import pytest
from pyspark.sql import types as T

import samplecraft as sc
from samplecraft.plans.staging import new_path

from .conftest import dataset, ids


def schema_of(ds, **kwargs):
    return {r.field: r for r in sc.get_field_schema(ds, **kwargs).collect()}


def test_field_schema(labelled):
    fields = schema_of(labelled)
    assert fields["filepath"].type == "StringField"
    assert (fields["tags"].type, fields["tags"].subfield) == ("ListField", "StringField")
    assert fields["animals"].subfield == "EmbeddedDocumentField"
    assert fields["animals"].embedded_doc_type.startswith("struct<id:string")
    assert not fields["tags"].required and not fields["tags"].read_only


def test_private_and_frame_fields(spark, ten):
    view = sc.sort_by(ten, "score")
    assert "_order" not in schema_of(view)
    assert "_order" in schema_of(view, include_private=True)
    frames = spark.createDataFrame([("s0", 1, True)], "sample_id string, frame_number int, key boolean")
    scopes = sc.get_field_schema(ten, frames=frames).groupBy("scope").count().collect()
    assert {r.scope: r["count"] for r in scopes} == {"sample": 6, "frame": 3}


@pytest.mark.parametrize(
    "kind, dtype",
    [
        ("StringField", "string"), ("IntField", "bigint"), ("FloatField", "double"),
        ("BooleanField", "boolean"), ("ListField", "array<string>"), ("DateTimeField", "timestamp"),
        ("GeoPointField", "struct<lon:double,lat:double>"),
    ],
)
def test_add_field(ten, kind, dtype):
    ds = sc.add_sample_field(ten, "extra", kind, description="more")
    assert ds.df.schema["extra"].dataType.simpleString() == dtype
    assert ds.df.filter("extra IS NOT NULL").count() == 0
    described = schema_of(ds)["extra"]
    assert (described.type, described.description) == (kind, "more")


def test_add_typed_lists_and_documents(ten):
    ds = sc.add_sample_field(ten, "extra", "ListField", subfield="FloatField")
    assert ds.df.schema["extra"].dataType == T.ArrayType(T.DoubleType())
    ds = sc.add_sample_field(ten, "extra", "EmbeddedDocumentField", embedded_doc_type="a INT, b STRING")
    assert ds.df.schema["extra"].dataType.simpleString() == "struct<a:int,b:string>"
    with pytest.raises(ValueError, match="embedded_doc_type"):
        sc.add_sample_field(ten, "extra", "EmbeddedDocumentField")


def test_add_field_errors(ten):
    with pytest.raises(ValueError, match="unknown field type 'Nope'.*BooleanField"):
        sc.add_sample_field(ten, "extra", "Nope")
    with pytest.raises(ValueError, match="unknown subfield type 'Nope'"):
        sc.add_sample_field(ten, "extra", "ListField", subfield="Nope")
    assert sc.add_sample_field(ten, "score", "FloatField") is ten
    with pytest.raises(ValueError, match="exists"):
        sc.add_sample_field(ten, "score", "StringField")


def test_infer_fields(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 2.5, "c": [1, 2]}', "nonsense", None]
    ds = dataset(spark, [(f"s{i}", t) for i, t in enumerate(texts)], "sample_id string, j string")
    typed = sc.infer_fields(ds, "j", into="typed")
    rows = [r.typed for r in typed.sorted_rows().collect()]
    assert [r and r.a for r in rows] == [1.0, 2.5, None, None]
    assert rows[0].b == "x" and rows[1].c == [1, 2]
    plain = dataset(spark, [("s", "3")], "sample_id string, j string")
    with pytest.raises(ValueError, match="JSON objects"):
        sc.infer_fields(plain, "j")


# -- summary -------------------------------------------------------------------------


def test_summary(spark):
    rows = [
        (f"s{i:03}", f"{i}.jpg", [f"t{i % 3}"], i, None if i % 2 else "even", i % 99,
         datetime.datetime(2024, 1, 1 + i % 3))
        for i in range(120)
    ]
    ds = dataset(
        spark, rows,
        "sample_id string, filepath string, tags array<string>, wide int, kind string, "
        "narrow int, at timestamp",
        name="many",
    )
    summary = sc.dataset_summary(ds)
    assert summary.overview.first().asDict() == {
        "name": "many", "media_type": None, "num_samples": 120, "first_sample_id": "s000"
    }
    assert {r.tag: r.n for r in summary.tags.collect()} == {"t0": 40, "t1": 40, "t2": 40}
    assert {r.field for r in summary.fields.collect()} == set(ds.df.columns)
    counts = {}
    for r in summary.value_counts.collect():
        counts.setdefault(r.field, {})[r.value] = r.n
    assert set(counts) == {"tags", "kind", "narrow", "at"}
    assert counts["kind"] == {"even": 60, None: 60}
    assert counts["at"] == {f"2024-01-0{d} 00:00:00": 40 for d in (1, 2, 3)}
    assert len(counts["narrow"]) == 99


def test_summary_cut_is_exact(spark):
    rows = [(f"s{i:03}", i % 100, i % 99 if i % 2 else None) for i in range(400)]
    ds = dataset(spark, rows, "sample_id string, hundred int, ninety_nine_and_null int")
    # 100 values are too many, and so are 99 and null
    assert sc.summary_value_counts(ds).count() == 0


def test_summary_values_take_one_scan(spark, tmp_path):
    rows = [(f"s{i:05}", i, f"name {i}", i % 98 or None, "" if i % 3 else None, [i % 7, None, 7] if i % 2 else None) for i in range(20_000)]
    made = dataset(spark, rows, "sample_id string, wide long, name string, narrow int, blank string, listed array<int>")
    made.df.repartition(5).write.parquet(str(tmp_path / "t"))
    counts = sc.summary_value_counts(sc.Dataset(spark.read.parquet(str(tmp_path / "t"))))
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    expected = collections.Counter()
    for _, _, _, narrow, blank, listed in rows:
        expected.update([("narrow", None if narrow is None else str(narrow)), ("blank", blank)])
        expected.update(("listed", None if v is None else str(v)) for v in listed or [])
    assert {(r.field, r.value): r.n for r in counts.collect()} == expected


def test_summary_of_nothing(spark):
    ds = dataset(spark, [], "sample_id string, v int")
    assert sc.dataset_summary(ds).overview.first().first_sample_id is None
    assert sc.summary_value_counts(ds).count() == 0


# -- names ---------------------------------------------------------------------------


def test_list_and_load(spark, ten, tmp_path):
    path = new_path(spark, "listed")
    sc.export_samples(ten.with_df(ten.df, name="ten", media_type="image", tags=("demo",), info={"v": 1}), path)
    sources = {"ten": path, "gone": str(tmp_path / "gone")}
    rows = {r.name: r for r in sc.list_datasets(spark, sources).collect()}
    assert (rows["ten"].num_samples, rows["ten"].media_type, rows["ten"].tags) == (10, "image", ["demo"])
    assert rows["ten"].error is None and rows["gone"].num_samples is None
    assert "PATH_NOT_FOUND" in rows["gone"].error
    ds = sc.load_dataset(spark, "ten", sources)
    info = sc.dataset_info(ds).first()
    assert info.num_samples == 10 and info.fields == ten.df.columns
    assert info.info == '{"v": 1}' and info.persistent
    with pytest.raises(sc.UnknownDataset):
        sc.load_dataset(spark, "nobody", sources)


def test_saved_views(spark, ten):
    sc.save_view(sc.sort_by(sc.match_tags(ten, "test"), "score", reverse=True), "tests_only", replace=True)
    assert ids(sc.load_view(spark, "tests_only")) == ["s8", "s9", "s7"]
    assert "tests_only" in {r.name for r in sc.list_datasets(spark).collect()}
    with pytest.raises(sc.UnknownDataset):
        sc.load_view(spark, "never_saved")


@pytest.mark.parametrize("format", ["parquet", "json", "csv", "orc"])
def test_round_trip(spark, labelled, format):
    path = new_path(spark, format)
    sc.export_samples(labelled, path, format=format)
    again = sc.import_samples(spark, path, format=format, schema=labelled.df.schema)
    plain = again.sorted_rows().select("sample_id", "filepath", "tags", "animals.id").collect()
    before = labelled.sorted_rows().select("sample_id", "filepath", "tags", "animals.id")
    assert plain == before.collect()
    if format in ("json", "csv"):
        with pytest.raises(ValueError, match="schema"):
            sc.import_samples(spark, path, format=format)
    with pytest.raises(Exception, match="already exists"):
        sc.export_samples(labelled, path, format=format)


def test_clone(spark, ten):
    copy = sc.clone_dataset(sc.sort_by(ten, "score"), new_path(spark, "clone"))
    assert ids(copy) == ids(sc.sort_by(ten, "score"))


def test_import_a_directory(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text(name * 3)
    ds = sc.import_samples(spark, str(tmp_path), format="binaryFile")
    rows = ds.sorted_rows().collect()
    assert [r.filepath.rsplit("/", 1)[-1] for r in rows] == ["a.txt", "b.txt"]
    assert [r.size_bytes for r in rows] == [15, 15] and len({r.sample_id for r in rows}) == 2
    assert "content" not in ds.df.columns


def test_imported_rows_get_ids(spark):
    path = new_path(spark, "plain")
    spark.createDataFrame([("x.jpg",), ("y.jpg",)], "filepath string").write.parquet(path)
    ds = sc.import_samples(spark, path)
    assert ds.df.filter("sample_id = md5(filepath)").count() == 2


# -- issues --------------------------------------------------------------------------


def test_find_issues(spark):
    rows = [
        ("a", "x.jpg", [], 1.0, ""), ("a", "x.jpg", None, float("nan"), "t"),
        ("b", "x.jpg", ["t"], None, None), ("c", None, ["t"], 2.0, "t"),
    ]
    ds = dataset(
        spark, rows, "sample_id string, filepath string, tags array<string>, v double, note string"
    )
    issues = {(r.field, r.issue): (r.n, r.share) for r in sc.find_issues(ds).collect()}
    assert issues[("v", "null")] == (1, 0.25) and issues[("v", "nan")] == (1, 0.25)
    assert issues[("note", "empty_string")][0] == 1 and issues[("note", "null")][0] == 1
    assert issues[("tags", "empty_list")][0] == 1 and issues[("tags", "null")][0] == 1
    assert issues[("sample_id", "duplicate")] == (1, 0.25)
    assert issues[("filepath", "duplicate")][0] == 2
    none = sc.find_issues(ds.with_df(ds.df.limit(0))).collect()
    assert {(r.n, r.share) for r in none} == {(0, 0.0)}


def test_a_damaged_file_has_an_error_in_its_row(spark, tmp_path):
    good, bad = str(tmp_path / "good"), tmp_path / "bad"
    spark.range(5).write.parquet(good)
    spark.range(5).coalesce(1).write.parquet(str(bad))
    part = next(p for p in bad.iterdir() if p.suffix == ".parquet")
    whole = part.read_bytes()
    (bad / "part-x.parquet").write_bytes(whole[:-20] + b"\0" * 20)
    rows = {r.name: r for r in sc.list_datasets(spark, {"good": good, "bad": str(bad), "gone": str(tmp_path / "no")}).collect()}
    assert rows["good"].num_samples == 5 and rows["good"].error is None
    assert rows["bad"].num_samples is None and rows["bad"].error
    assert rows["gone"].num_samples is None and rows["gone"].error


def test_views_in_a_folder(spark, ten, tmp_path):
    folder, stages = str(tmp_path), [{"type": "MatchTags", "tags": ["train"]}, {"type": "SortBy", "field_or_expr": "score"}]
    view = sc.apply_stages(ten, stages)
    sc.save_view(view, "samples", folder)
    sc.save_view(ten, "stages", folder, stages=stages)
    expected = [r.sample_id for r in view.sorted_rows().collect()]
    for name in ("samples", "stages"):
        assert [r.sample_id for r in sc.load_view(spark, name, folder, ten).sorted_rows().collect()] == expected
    with pytest.raises(Exception, match="exist"):
        sc.save_view(view, "samples", folder)
    with pytest.raises(ValueError, match="name the dataset"):
        sc.load_view(spark, "stages", folder)
    with pytest.raises(sc.UnknownDataset):
        sc.load_view(spark, "other", folder)
    with pytest.raises(ValueError):
        sc.save_view(ten, "bad", folder, stages=[{"type": "Nothing"}])
    sc.save_view(view, "taken")
    with pytest.raises(ValueError, match="saved already"):
        sc.save_view(view, "taken")
