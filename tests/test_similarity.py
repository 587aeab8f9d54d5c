"""Similarity against brute force, with copies, many cells and one cell."""

import re

import numpy as np
import pytest

import samplecraft as sc
from samplecraft.operators.similarity import embedding_field
from samplecraft.plans import vector_cells

from .conftest import dataset, ids


def vectors(spark, matrix, partitions=None):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return dataset(spark, rows, "sample_id long, embedding array<float>", partitions)


def clustered(n=240, dim=6, seed=0):
    """Clusters, and a third of all rows copies of one vector."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(8, dim))
    m = centres[random.integers(0, 8, n)] + 0.15 * random.normal(size=(n, dim))
    m[random.choice(n, n // 3, replace=False)] = m[0]
    return m.astype(np.float32)


@pytest.fixture
def small_chunks(monkeypatch):
    """Several chunks per cell and several tiles per chunk, as with much data."""
    monkeypatch.setattr(vector_cells, "CHUNK_ROWS", 11)
    monkeypatch.setattr(vector_cells, "TILE_ROWS", 5)


def cosines(a, b):
    a, b = a.astype(float), b.astype(float)
    a = a / np.linalg.norm(a, axis=1, keepdims=True)
    b = b / np.linalg.norm(b, axis=1, keepdims=True)
    return a @ b.T


@pytest.mark.parametrize("cell_rows, threshold", [(8, 0.9), (40, 0.995), (2_048, 0.9)])
def test_near_duplicates(spark, small_chunks, cell_rows, threshold):
    m = clustered()
    found = sc.near_duplicates(vectors(spark, m), threshold, cell_rows=cell_rows).collect()
    close = cosines(m, m) >= threshold
    np.fill_diagonal(close, True)
    expected = {
        b: (int(close[b].argmax()), int(close[b].sum()) - 1)
        for b in range(len(m))
        if close[b].argmax() < b
    }
    assert {r.id_b: (r.id_a, r.n_near) for r in found} == expected
    assert len(found) == len(expected)
    for r in found:
        assert r.cosine == pytest.approx(cosines(m, m)[r.id_a, r.id_b], abs=1e-9)


def test_copies_are_near_duplicates_at_threshold_one(spark):
    m = clustered()
    found = sc.near_duplicates(vectors(spark, m), 1.0, cell_rows=16).collect()
    copies = np.nonzero((m == m[0]).all(axis=1))[0]
    assert {r.id_b for r in found} >= set(copies[1:].tolist())
    assert {r.n_near for r in found if r.id_b in copies} == {len(copies) - 1}


@pytest.mark.parametrize(
    "cell_rows, metric", [(8, "cosine"), (40, "euclidean"), (2_048, "cosine")]
)
def test_knn_self_join(spark, small_chunks, cell_rows, metric):
    m = clustered()
    ds = vectors(spark, m, partitions=5)
    k = 4
    found = sc.knn_join(ds, ds, k, metric=metric, exclude_self=True, cell_rows=cell_rows)
    if metric == "cosine":
        apart = 1.0 - cosines(m, m)
    else:
        apart = np.linalg.norm(m[:, None].astype(float) - m[None].astype(float), axis=2)
    same = (m[:, None] == m[None]).all(axis=2)
    apart[same] = 0.0
    np.fill_diagonal(apart, np.inf)
    got = {(r.query_id, r["rank"]): (r.neighbour_id, r.distance) for r in found.collect()}
    assert len(got) == len(m) * k
    for q in range(len(m)):
        order = np.lexsort((np.arange(len(m)), apart[q]))[:k]
        for rank, j in enumerate(order, start=1):
            neighbour, distance = got[(q, rank)]
            assert distance == pytest.approx(apart[q, j], abs=1e-6)
            assert neighbour == j or apart[q, neighbour] == pytest.approx(apart[q, j], abs=1e-9)
    copies = np.nonzero(same[0])[0]
    for q in copies:  # copies of one vector: the smallest other ids
        others = [j for j in copies if j != q][:k]
        assert [got[(q, r)][0] for r in range(1, k + 1)] == others


def test_copies_tie_by_smallest_id(spark):
    m = np.tile(np.array([[1.0, 2.0]], np.float32), (30, 1))
    ds = vectors(spark, m, partitions=4)
    found = sc.knn_join(ds, ds, 2, exclude_self=True).collect()
    near = {(r.query_id, r["rank"]): r.neighbour_id for r in found}
    assert near[(0, 1)] == 1 and near[(0, 2)] == 2
    assert near[(1, 1)] == 0 and near[(1, 2)] == 2
    assert near[(29, 1)] == 0 and near[(29, 2)] == 1
    assert len(found) == 60


@pytest.mark.parametrize("cell_rows", [16, 2_048])
def test_knn_join_of_two_tables(spark, small_chunks, cell_rows):
    base, asked = clustered(seed=1), clustered(n=50, seed=2)
    found = sc.knn_join(vectors(spark, asked), vectors(spark, base), 3, cell_rows=cell_rows)
    got = {(r.query_id, r["rank"]): r.distance for r in found.collect()}
    apart = np.sort(1.0 - cosines(asked, base), axis=1)[:, :3]
    assert len(got) == 150
    for (q, rank), distance in got.items():
        assert distance == pytest.approx(apart[q, rank - 1], abs=1e-9)


def test_many_groups_without_a_cell_size(spark, small_chunks):
    """The plan of a large table: more vectors than any one cell or chunk holds."""
    m = clustered(n=700, dim=5, seed=9)
    found = sc.near_duplicates(vectors(spark, m), 0.97).collect()
    close = cosines(m, m) >= 0.97
    np.fill_diagonal(close, True)
    assert {r.id_b: r.n_near for r in found} == {
        b: int(close[b].sum()) - 1 for b in range(len(m)) if close[b].argmax() < b
    }
    assert sc.uniqueness(vectors(spark, m), k=3).count() == len(m)


def test_parallel_vectors_are_near_at_threshold_one(spark):
    random = np.random.default_rng(3)
    one = random.normal(size=(50, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([one, 3 * one]))]
    ds = dataset(spark, rows, "sample_id long, embedding array<double>")
    found = {(r.id_a, r.id_b) for r in sc.near_duplicates(ds, 1.0).collect()}
    assert found == {(i, i + 50) for i in range(50)}


def test_a_vector_of_many_samples_and_a_large_k(spark):
    m = np.tile(np.array([[1.0, 2.0]], np.float32), (1500, 1))
    plan = sc.knn_join(vectors(spark, m, partitions=3), vectors(spark, m[:1200], partitions=3), 1100)
    got = plan.filter("query_id = 7").orderBy("rank").collect()
    assert [r.neighbour_id for r in got] == list(range(1100))


def test_knn_asks_for_more_than_there_is(spark):
    ds = vectors(spark, np.eye(3, dtype=np.float32))
    assert sc.knn_join(ds, ds, 10, exclude_self=True, cell_rows=1).count() == 6
    assert sc.knn_join(ds, ds, 10).count() == 9


@pytest.mark.parametrize("cell_rows", [16, 2_048])
def test_uniqueness(spark, small_chunks, cell_rows):
    m = clustered()
    rows = sc.uniqueness(vectors(spark, m), k=5, cell_rows=cell_rows).collect()
    found = {r.id: r.uniqueness for r in rows}
    apart = 1.0 - cosines(m, m)
    apart[(m[:, None] == m[None]).all(axis=2)] = 0.0
    np.fill_diagonal(apart, np.inf)
    means = np.sort(apart, axis=1)[:, :5].mean(axis=1)
    assert len(found) == len(m)
    for i, value in found.items():
        assert value == pytest.approx(means[i] / means.max(), abs=1e-9)


def test_unusable_vectors_are_left_out(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, None]),
        (5, [2.0, 0.0]),
    ]
    ds = dataset(spark, rows, "sample_id long, embedding array<double>")
    found = sc.near_duplicates(ds, 0.99).collect()
    assert [(r.id_a, r.id_b, r.n_near) for r in found] == [(0, 5, 1)]
    assert ids(sc.sort_by_similarity(ds, [1.0, 0.0])) == [0, 5]
    nothing = ds.with_df(ds.df.filter("sample_id = 1"))
    assert sc.near_duplicates(nothing, 0.9).count() == 0
    assert sc.uniqueness(nothing).count() == 0
    assert sc.knn_join(nothing, nothing, 1).count() == 0


def test_vectors_of_two_lengths_fail(spark):
    ds = dataset(spark, [(0, [1.0, 0.0]), (1, [1.0])], "sample_id long, embedding array<double>")
    with pytest.raises(Exception, match="different lengths"):
        sc.near_duplicates(ds, 0.5).count()


def test_sort_by_similarity(spark):
    m = clustered(60)
    ds = vectors(spark, m)
    close = 1.0 - cosines(m, m)
    by_id = sc.sort_by_similarity(ds, 7, k=10, dist_field="d")
    rows = by_id.sorted_rows().collect()
    assert [r.d for r in rows] == pytest.approx(sorted(close[7])[:10], abs=1e-6)
    mean = m[[1, 2]].astype(float).mean(axis=0, keepdims=True)
    by_ids = sc.sort_by_similarity(ds, [1, 2], dist_field="d").sorted_rows().collect()
    assert [r.d for r in by_ids] == pytest.approx(sorted(1.0 - cosines(mean, m)[0]), abs=1e-6)
    far = sc.sort_by_similarity(ds, [float(x) for x in m[0]], k=3, metric="euclidean", dist_field="d")
    apart = np.linalg.norm(m.astype(float) - m[0].astype(float), axis=1)
    assert [r.d for r in far.sorted_rows().collect()] == pytest.approx(sorted(apart)[:3], abs=1e-6)


def test_similarity_errors(spark, ten):
    ds = vectors(spark, np.eye(2, dtype=np.float32))
    with pytest.raises(ValueError, match="no sample"):
        sc.sort_by_similarity(ds, 99)
    with pytest.raises(ValueError, match="metric"):
        sc.sort_by_similarity(ds, 0, metric="manhattan")
    with pytest.raises(ValueError, match="found 0"):
        embedding_field(ten)
    with pytest.raises(ValueError, match="threshold"):
        sc.near_duplicates(ds, 0.0)
    with pytest.raises(ValueError, match="k must"):
        sc.knn_join(ds, ds, 0)


def test_a_vector_is_not_taken_for_ids(spark):
    m = clustered(30)
    ds = vectors(spark, m)
    named = dataset(
        spark, [(f"s{i}", [float(x) for x in v]) for i, v in enumerate(m)], "sample_id string, embedding array<float>"
    )
    axis = [1, 0, 0, 0, 0, 0]
    apart = 1.0 - cosines(np.array([axis], float), m)[0]
    expected = pytest.approx(np.sort(apart), abs=1e-9)
    for view in (
        sc.sort_by_similarity(named, axis, dist_field="d"),
        sc.sort_by_similarity(named, np.array(axis), dist_field="d"),
        sc.sort_by_similarity(ds, vector=axis, dist_field="d"),
        sc.sort_by_similarity(ds, np.array(axis, np.float32), dist_field="d"),
        sc.sort_by_similarity(ds, [np.float64(x) for x in axis], dist_field="d"),
    ):
        assert [r.d for r in view.sorted_rows().collect()] == expected
    by_ids = sc.sort_by_similarity(ds, np.array([1, 2]), dist_field="d").sorted_rows().first()
    assert by_ids.d == pytest.approx((1.0 - cosines(m[[1, 2]].mean(axis=0, keepdims=True), m)[0]).min(), abs=1e-6)


def test_wrong_query_vectors_raise(spark):
    ds = vectors(spark, np.eye(3, dtype=np.float32))
    with pytest.raises(Exception, match="3 dimensions, the query 2"):
        sc.sort_by_similarity(ds, [1.0, 0.0]).df.count()
    with pytest.raises(ValueError, match="length zero"):
        sc.sort_by_similarity(ds, [0.0, 0.0, 0.0])
    with pytest.raises(ValueError, match="either"):
        sc.sort_by_similarity(ds)
    with pytest.raises(ValueError, match="either"):
        sc.sort_by_similarity(ds, 1, vector=[1.0, 0.0, 0.0])


def brute_nearest(m, target, k, metric, among):
    m, target = np.where(m.any(axis=1, keepdims=True), m, 1e-9).astype(float), np.asarray(target, float)
    if metric == "cosine":
        apart = 1 - (m @ target) / np.linalg.norm(m, axis=1) / np.linalg.norm(target)
    else:
        apart = np.linalg.norm(m - target, axis=1)
    order = [i for i in np.lexsort((np.arange(len(m)), np.round(apart, 9))) if i in among]
    return order[:k], apart


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_a_stored_index_gives_the_nearest(spark, tmp_path, monkeypatch, metric):
    from samplecraft.sources import similarity_index

    monkeypatch.setattr(similarity_index, "FILE_ROWS", 16)
    m = clustered(400)
    m[7] = 0
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(m)] + [(900, None), (901, [float("nan")] * 6)]
    ds = dataset(spark, rows, "sample_id long, embedding array<float>")
    sc.build_similarity_index(ds, "key", str(tmp_path), metric=metric, cell_rows=12)
    index = sc.open_similarity_index(spark, "key", str(tmp_path))
    stored = set(range(len(m))) - ({7} if metric == "cosine" else set())
    assert {r.id for r in index.members.collect()} == stored
    assert index.rows.sum() == len(stored)
    view = sc.match(ds, "sample_id % 7 = 3")
    rng = np.random.default_rng(3)
    for target, k in ((m[5], 10), (m[0], 200), (rng.normal(size=6), 25), (rng.normal(size=6) * 9, 3), (m[9], 10_000)):
        target = [float(x) for x in target]
        expected, apart = brute_nearest(m, target, k, metric, stored)
        got = index.nearest(target, k).collect()
        assert np.allclose([r.distance for r in got], apart[expected], atol=1e-6)
        assert len(got) == len(expected) == len({r.id for r in got})
        expected, _ = brute_nearest(m, target, k, metric, {i for i in stored if i % 7 == 3})
        near = sc.sort_by_similarity(view, vector=target, k=k, index=index, dist_field="far").sorted_rows().collect()
        assert np.allclose([r.far for r in near], apart[expected], atol=1e-6) and len(near) == len(expected)
        assert {r.sample_id % 7 for r in near} <= {3}


def test_a_search_reads_only_cells_that_can_hold_the_nearest(spark, tmp_path):
    m = clustered(600, dim=3)
    index = sc.build_similarity_index(vectors(spark, m), "key", str(tmp_path), cell_rows=10)
    low, high = index.bounds([float(x) for x in m[3]])
    cells = {r.id: r.cell for r in index.members.collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    apart = np.linalg.norm(unit - unit[3], axis=1)
    for i, cell in cells.items():
        at = np.flatnonzero(index.cells == cell)[0]
        assert low[at] <= apart[i] <= high[at]
    found = index.nearest([float(x) for x in m[3]], 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    named = {int(c) for c in re.findall(r"\d+", re.search(r"PartitionFilters: \[cell\S* IN \(([\d,]+)\)", found._jdf.queryExecution().simpleString())[1])}
    assert 0 < len(named) < len(index.cells)


def test_index_errors(spark, tmp_path):
    ds = vectors(spark, clustered(60))
    with pytest.raises(ValueError, match="no similarity index"):
        sc.open_similarity_index(spark, "none", str(tmp_path))
    with pytest.raises(ValueError, match="no key"):
        sc.build_similarity_index(ds, "a/b", str(tmp_path))
    with pytest.raises(ValueError, match="no vector"):
        sc.build_similarity_index(ds.with_df(ds.df.limit(0)), "empty", str(tmp_path))
    with pytest.raises(ValueError, match="not built"):
        sc.open_similarity_index(spark, "empty", str(tmp_path))
    index = sc.build_similarity_index(ds, "key", str(tmp_path))
    for bad in ([1.0, 2.0], [0.0] * 6):
        with pytest.raises(ValueError):
            index.nearest(bad, 3)
    with pytest.raises(ValueError, match="needs k"):
        sc.sort_by_similarity(ds, vector=[1.0] * 6, index=index)
    with pytest.raises(ValueError):
        index.nearest([1.0] * 6, 0)


def sent(spark, monkeypatch, join):
    """How often a join hands a vector to a task. Of its 3,000 vectors without structure
    the bounds rule none out, in whatever cell."""
    rows, matrix = spark.sparkContext.accumulator(0), vector_cells.matrix

    def counted(column, unit):
        rows.add(len(column))
        return matrix(column, unit)

    m = np.random.default_rng(5).normal(size=(3_000, 16)).astype(np.float32)
    with monkeypatch.context() as patch:
        patch.setattr(vector_cells, "matrix", counted)
        assert join(vectors(spark, m, partitions=4)).count() > 0
    assert rows.value >= len(m)
    return rows.value / len(m)


def test_uniqueness_does_not_send_every_vector_to_every_cell(spark, monkeypatch):
    assert sent(spark, monkeypatch, lambda ds: sc.uniqueness(ds, k=5, cell_rows=8)) < 12


def test_knn_self_join_does_not_send_every_vector_to_every_cell(spark, monkeypatch):
    assert sent(spark, monkeypatch, lambda ds: sc.knn_join(ds, ds, 5, exclude_self=True, cell_rows=8)) < 12


def test_near_duplicates_without_structure_are_exact_in_cells_and_blocks(spark, monkeypatch):
    """Blocks meet once for both sides, and what single precision leaves open is settled."""
    m = np.random.default_rng(6).normal(size=(900, 12)).astype(np.float32)
    least = float(np.sort(cosines(m, m)[:300, 300:], axis=None)[-400])  # a cosine that occurs
    with monkeypatch.context() as patch:
        patch.setattr(vector_cells, "CHUNK_ROWS", 128)
        found = sc.near_duplicates(vectors(spark, m), least, cell_rows=16).collect()
    close = cosines(m, m) >= least - vector_cells.COSINE_SLACK
    np.fill_diagonal(close, True)
    assert {r.id_b: (r.id_a, r.n_near) for r in found} == {
        b: (int(close[b].argmax()), int(close[b].sum()) - 1) for b in range(len(m)) if close[b].argmax() < b
    }
    assert sent(spark, monkeypatch, lambda ds: sc.near_duplicates(ds, 0.4, cell_rows=8)) < 12


def test_near_duplicates_do_not_send_every_vector_to_every_cell(spark, monkeypatch):
    assert sent(spark, monkeypatch, lambda ds: sc.near_duplicates(ds, 0.35)) < 12
    assert sent(spark, monkeypatch, lambda ds: sc.near_duplicates(ds, 0.35, cell_rows=8)) < 12


def test_knn_of_two_tables_does_not_send_every_vector_to_every_cell(spark, monkeypatch):
    def join(ds):
        asked, base = sc.match(ds, "sample_id % 2 = 0"), sc.match(ds, "sample_id % 2 = 1")
        return sc.knn_join(asked, base, 3, metric="euclidean", cell_rows=8)

    assert sent(spark, monkeypatch, join) < 12


@pytest.mark.parametrize("least, cell_rows", [(0.4, 8), (0.35, None)])
def test_what_near_duplicates_send_grows_as_the_table(spark, monkeypatch, least, cell_rows):
    """Vectors without structure, so that all blocks meet: three times as many vectors are
    sent three times as often, not nine times."""
    monkeypatch.setattr(vector_cells, "BLOCK_LEAST", 128, raising=False)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 3)  # cores, and so blocks
    handed, matrix = spark.sparkContext.accumulator(0), vector_cells.matrix

    def counted(column, unit):
        handed.add(len(column))
        return matrix(column, unit)

    monkeypatch.setattr(vector_cells, "matrix", counted)
    m = np.random.default_rng(7).normal(size=(3_600, 16)).astype(np.float32)
    times = []  # each vector is sent
    for rows in (1_200, 3_600):
        before = handed.value
        assert sc.near_duplicates(vectors(spark, m[:rows], 4), least, cell_rows=cell_rows).count() > 0
        times.append((handed.value - before) / rows)
    assert 1 <= times[1] < 1.3 * times[0]
