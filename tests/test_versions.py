"""Stores: changes and batches that are written on their own and merged when read."""

import random

import pytest

import samplecraft as sc
from samplecraft.plans.staging import new_path

from .conftest import dataset


def rows(ds):
    """All samples as plain values, by id, with the columns in order."""
    return ds.df.columns, {r[ds.id_col]: tuple(r) for r in ds.df.collect()}


def same(store, ds, version=None):
    """The store's view is the one that rewriting gave."""
    ours, theirs = store.dataset(version), ds
    assert ours.public_columns() == theirs.public_columns()
    assert rows(ours) == rows(theirs.with_df(theirs.df.select(*ours.df.columns)))
    assert (ours.id_col, ours.order, ours.reverse) == (theirs.id_col, theirs.order, theirs.reverse)


@pytest.fixture()
def base(spark):
    made = [(f"k{i}", i * 10, f"f/{i}.png", [["a"], [], None, ["b", "a"]][i % 4], None if i % 3 else float(i)) for i in range(12)]
    schema = "sample_id string, place long, filepath string, tags array<string>, weight double"
    return dataset(spark, made, schema, partitions=3, order=("place",))


@pytest.fixture()
def store(spark, base):
    return sc.create_store(base, new_path(spark, "store"))


def written(store, version):
    return next(e.rows for e in store.entries() if e.version == version)


def test_create_and_open(spark, store, base):
    same(sc.open_store(spark, store.path), base)
    assert store.version() == 0 and [tuple(r) for r in store.history().collect()] == [(0, "compact", None, None, 12, 12)]
    with pytest.raises(ValueError, match="already"):
        sc.create_store(base, store.path)
    with pytest.raises(ValueError, match="no store"):
        sc.open_store(spark, store.path + "-other")
    with pytest.raises(ValueError, match="no version 4"):
        store.dataset(4)


def test_tags_write_only_what_changes(store, base):
    ids = ["k1", "k3", "k4", "unknown"]
    assert store.tag_samples(["a", "new"], sample_ids=ids) == 3 and written(store, 1) == 3
    once = sc.tag_samples(base, ["a", "new"], sample_ids=ids).dataset
    same(store, once)
    # Tagged already: counted, and no row is written.
    assert store.tag_samples("new", sample_ids=["k1", "k3"]) == 2 and written(store, 2) == 0
    same(store, once)
    assert store.untag_samples("a", view=[{"type": "MatchTags", "tags": ["new"]}]) == 3
    twice = sc.untag_samples(once, "a", view=sc.match_tags(once, "new")).dataset
    same(store, twice)
    assert store.untag_samples("b", view=lambda ds: sc.match(ds, "place < 50")) == 5
    assert written(store, 4) == 1
    assert store.tag_samples("x", sample_ids=[]) == 0 and store.tag_samples("x") == 12
    same(store, once, 1)
    same(store, twice, 3)
    same(store, base, 0)


def test_values_of_a_mapping(store, base):
    values = {"k0": 1.5, "k2": None, "k9": 2.5, "nobody": 3.0}
    assert store.set_values("weight", values) == 2 and written(store, 1) == 2
    after = sc.set_values(base, "weight", values).dataset
    same(store, after)
    assert store.set_values("weight", values, keep_unmatched=True) == 2 and written(store, 2) == 3
    same(store, sc.set_values(after, "weight", values, keep_unmatched=True).dataset)
    assert store.set_values("grade", {"k1": "good"}, keep_unmatched=True) == 1
    assert store.set_values("grade", {"k5": "bad"}, keep_unmatched=True) == 1
    assert store.set_values("grade", {"k7": "late"}) == 1
    found = {r.sample_id: r.grade for r in store.dataset().df.collect()}
    assert {k: v for k, v in found.items() if v} == {"k7": "late"}
    assert {k: v for k, v in {r.sample_id: r.grade for r in store.dataset(4).df.collect()}.items() if v} == {"k1": "good", "k5": "bad"}


def test_values_of_a_table_by_another_key(spark, store, base):
    table = spark.createDataFrame([(20, 7.0), (30, None), (999, 1.0)], "k long, v double")
    assert store.set_values("weight", table, key_field="place", keep_unmatched=True) == 1
    same(store, sc.set_values(base, "weight", table, key_field="place", keep_unmatched=True).dataset)
    twice = spark.createDataFrame([("k1", 1.0), ("k1", 2.0)], "k string, v double")
    with pytest.raises(Exception, match="more than one value"):
        store.set_values("weight", twice)
    assert store.version() == 1  # what failed is no version


def test_values_in_order(store, base):
    assert store.set_values("turn", list(range(12))) == 12
    same(store, sc.set_values(base, "turn", list(range(12))).dataset)
    with pytest.raises(ValueError):
        store.set_values("turn", [1, 2])


def test_a_nested_field(spark):
    ds = dataset(spark, [("a", (1, "x")), ("b", None)], "sample_id string, meta struct<n:long,s:string>")
    store = sc.create_store(ds, new_path(spark, "store"))
    assert store.set_values("meta.n", {"a": 5}, keep_unmatched=True) == 1
    assert {r.sample_id: r.meta for r in store.dataset().df.collect()} == {"a": (5, "x"), "b": None}


def test_append(spark, store, base):
    batch = [{"filepath": "n/1"}, {"filepath": "n/2", "weight": 9.0, "extra": "e"}]
    assert store.add_samples(batch, "b1") == 2 and written(store, 1) == 2
    grown = sc.add_samples(base, batch, "b1").dataset
    same(store, grown)
    # A retry gives one copy, and so does a corrected batch of the same key.
    assert store.add_samples(batch, "b1") == 2
    same(store, grown)
    new = {r.filepath: r.sample_id for r in store.dataset().df.collect()}["n/2"]
    store.tag_samples("kept", sample_ids=[new])
    assert store.add_samples([*batch, {"filepath": "n/3"}], "b1") == 3
    found = {r.filepath: r.tags for r in store.dataset().df.collect()}
    assert len(found) == 15 and found["n/2"] == ["kept"] and found["n/3"] is None
    assert store.add_samples(batch, "b2") == 2 and store.dataset().df.count() == 17
    with pytest.raises(ValueError, match="filepath"):
        store.add_samples([{"filepath": "ok"}, {"filepath": ""}], "b3")
    assert store.dataset().df.count() == 17
    places = [r.place for r in store.dataset().sorted_rows().collect()]
    assert places == sorted(places) and places[:12] == [i * 10 for i in range(12)]


def test_values_reset_what_is_there_and_not_what_comes_later(store):
    store.set_values("weight", {"k0": 4.0})
    store.add_samples([{"filepath": "late", "weight": 8.0}], "b")
    weights = {r.filepath: r.weight for r in store.dataset().df.collect()}
    assert {k: v for k, v in weights.items() if v is not None} == {"f/0.png": 4.0, "late": 8.0}


def test_compaction(spark, store, base):
    store.tag_samples("t", sample_ids=["k1"])
    store.set_values("grade", {"k2": "g"}, keep_unmatched=True)
    store.add_samples([{"filepath": "n/1", "grade": "new"}], "b1")
    before = rows(store.dataset())
    assert store.compact() == 13
    assert rows(store.dataset()) == before and rows(store.dataset(3)) == before
    assert store.dataset().order == ("place",)
    store.untag_samples("t")
    store.set_values("grade", {"k3": "h"})
    assert {r.sample_id: r.grade for r in store.dataset().df.collect() if r.grade} == {"k3": "h"}
    assert store.add_samples([{"filepath": "n/2"}], "b2") == 1 and store.dataset().df.count() == 14
    same(store, base, 0)


def test_a_batch_again_after_compaction(store):
    batch = [{"filepath": "n/1"}, {"filepath": "n/2"}]
    store.add_samples(batch, "b1")
    store.add_samples([{"filepath": "n/9"}], "b2")
    store.compact()
    store.add_samples(batch[:1], "b1")
    found = sorted(r.filepath for r in store.dataset().df.collect() if r.filepath.startswith("n/"))
    assert found == ["n/1", "n/9"] and store.compact() == 14
    store.add_samples(batch, "b2")
    assert sorted(r.filepath for r in store.dataset().df.collect() if r.filepath.startswith("n/")) == ["n/1", "n/1", "n/2"]


def test_one_join_however_many_changes(store):
    for i in range(6):
        store.tag_samples(f"t{i}", sample_ids=[f"k{i}"])
        store.set_values(f"f{i % 2}", {f"k{i}": i}, keep_unmatched=True)
    plan = store.dataset().df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Aggregate") == 1 and plan.count("Relation") == 2


def test_a_write_that_failed_is_not_read(spark, store, base):
    """Files without a log entry, as a writer leaves them that dies before its entry."""
    spark.range(3).selectExpr("cast(id AS string) AS sample_id").write.parquet(f"{store.path}/samples-lost")
    same(store, base)
    log = store.entries()
    store.tag_samples("x", sample_ids=["k1"])
    with pytest.raises(Exception, match="(?i)exists"):  # a second writer of the same version
        store._log(log, "change", "nowhere", 0, 0)
    assert store.version() == 1


def test_random_changes_against_rewriting(spark, store, base):
    rng, ds, kept = random.Random(4), base, {0: base}
    for _ in range(14):
        some = rng.sample([f"k{i}" for i in range(14)], rng.randint(0, 5))
        kind = rng.choice(["tag", "untag", "set", "keep", "compact"])
        if kind in ("tag", "untag"):
            tags = rng.sample(["a", "b", "c"], 2)
            pick = getattr(sc, f"{kind}_samples")(ds, tags, sample_ids=some)
            assert getattr(store, f"{kind}_samples")(tags, sample_ids=some) == pick.count().first().n
            ds = pick.dataset
        elif kind in ("set", "keep"):
            field = rng.choice(["weight", "score"])
            values = {k: rng.choice([1.5, 2.5, None]) for k in some} | {"k0": 0.5}
            pick = sc.set_values(ds, field, values, keep_unmatched=kind == "keep")
            assert store.set_values(field, values, keep_unmatched=kind == "keep") == pick.count().first().n
            ds = pick.dataset
        else:
            store.compact()
        ds = ds.with_df(spark.createDataFrame(ds.df.collect(), ds.df.schema))
        kept[store.version()] = ds
    for version, then in kept.items():
        ours = store.dataset(version)
        assert rows(ours) == rows(then.with_df(then.df.select(*ours.df.columns)))
