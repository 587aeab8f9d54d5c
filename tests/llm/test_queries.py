"""The registered queries and the pipeline on the smallest tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from samplecraft.llm import quality, queries, tokens

from .. import oracle
from .conftest import CLASHING, corpus
from .test_documents import brute_classes, brute_lines, brute_overlaps

FOLDER = "/root/testdata/sf0.001"


def read(name):
    return pd.read_parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="module")
def library():
    return tokens.Encoder(tokens.WORD_TOKENIZER).tokenizer


def test_one_query_for_each_operator():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_points.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert oracle.differences(df, oracle.connect(FOLDER), entry_points.oracle_sql()[name]) is None


def test_packing(spark, library):
    rows = queries.QUERIES["op2_packing"](spark, FOLDER).toPandas()
    docs = read("documents").set_index("doc_id")
    for key, pieces in rows.sort_values("start").groupby("doc_id"):
        ids = np.array(library.encode(docs.text[key], add_special_tokens=False).ids + [1], "<u4")
        assert set(pieces.doc_tokens) == {len(ids)} and pieces.length.sum() == len(ids)
        for r in pieces.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert set(rows.doc_id) == set(docs.index)
    for _, pieces in rows.sort_values("offset").groupby("sequence_id"):
        assert (pieces.offset == pieces.length.cumsum() - pieces.length).all() and pieces.length.sum() <= 2048


def test_token_files(spark, library):
    rows = queries.QUERIES["op5_token_files"](spark, FOLDER).toPandas().sort_values("doc_id")
    docs, start = read("documents").set_index("doc_id"), 0
    assert rows.doc_id.tolist() == sorted(docs.index)
    for r in rows.itertuples():
        ids = np.array(library.encode(docs.text[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_fingerprints(spark):
    rows = queries.QUERIES["op3_fingerprints"](spark, FOLDER).toPandas().set_index("doc_id")
    docs = read("documents").sort_values("doc_id", ascending=False)
    texts = docs.text.tolist()
    for key, text, follow in zip(docs.doc_id, texts, [*texts[1:], texts[0]]):
        edited = text[: len(text) - len(text) // 2] + follow[: len(text) // 2]
        assert rows.edited_sha256[key] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows.n_chars[key] == len(text)
    by_text = defaultdict(set)
    for key, text in zip(docs.doc_id, texts):
        by_text[text].add(rows.fingerprint[key])
    assert all(len(prints) == 1 for prints in by_text.values())
    assert rows.near_edited.median() > 0.2 > rows.near_next.median()


def test_pages(spark):
    rows = queries.QUERIES["op6_html_text"](spark, FOLDER).toPandas()
    assert len(rows) == len(read("pages")) and (rows.n_chars == rows.text.str.len()).all()
    assert (rows.text.str.len() > 0).all() and not rows.text.str.contains("track|</").any()


def test_token_counts(spark):
    rows = queries.QUERIES["op8_token_counts"](spark, FOLDER).toPandas()
    per = rows.groupby("doc_id").agg(n=("n_tokens", "sum"), whole=("doc_tokens", "first"), lines=("section", "size"))
    assert (per.n == per.whole).all()
    docs = read("documents").set_index("doc_id")
    assert (per.lines == docs.text.str.count("\n") + 1).all()


def test_quality(spark):
    rows = queries.QUERIES["op10_quality"](spark, FOLDER).toPandas()
    assert len(rows) == len(read("documents")) and set(rows.columns) == {"doc_id", "quality_score", "toxic_score", "accepted"}


def test_quality_of_documents_whose_labels_were_kept_back(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, labels.filter("doc_id % 4 != 0"), ("quality", "toxic"))
    held = docs.join(labels.filter("doc_id % 4 = 0"), "doc_id", "left_semi")
    rows = quality.score(held, model).select("doc_id", "quality_score", "toxic_score").toPandas()
    rows = rows.merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    assert ((rows.quality_score >= 0.5) == (rows.quality == 1)).mean() >= 0.97
    assert ((rows.toxic_score >= 0.5) == (rows.toxic == 1)).mean() >= 0.95
    clean = rows[(rows.quality == 1) & (rows.toxic == 0)]
    assert ((clean.quality_score >= 0.5) & (clean.toxic_score < 0.5)).mean() >= 0.98


def plain(df, names=("doc_id", "text")):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_each_stage_of_the_pipeline(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    benchmark = [tuple(r) for r in read("benchmark").itertuples(index=False)]
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
            out = corpus_pipeline.staged(out, "test")
        outputs.append((name, docs, out))
        docs = out
    (_, whole, good), (_, _, deduped), (_, _, single), (_, _, clean), (_, _, packed) = outputs

    labels = read("labels").set_index("doc_id")
    kept = {k for k, _ in plain(good)}
    right = [(k in kept) == (labels.quality[k] == 1 and labels.toxic[k] == 0) for k in labels.index]
    assert np.mean(right) >= 0.9 and Counter(plain(good)) <= Counter(plain(whole))

    expected = {k: t for k, (t, n) in brute_lines(plain(good)).items() if t is not None or not n}
    assert dict(plain(deduped)) == expected
    assert all(r.n_chars == len(r.text) for r in deduped.collect())

    low = {k: c for k, c, _ in brute_classes(plain(deduped))}
    assert {k for k, _ in plain(single)} == {k for k, c in low.items() if k == c}

    bad = {k for k, _ in brute_overlaps(plain(single), benchmark)}
    assert Counter(plain(clean)) == Counter(r for r in plain(single) if r[0] not in bad)

    size = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in plain(clean))
    assert sum(r.length for r in packed.collect()) == size
    run = corpus_pipeline.run(spark, FOLDER)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert run.columns == packed.columns
    assert sum(r.length for r in run.select(columns).collect()) == size


def test_stages_on_awkward_tables(spark):
    rows = [(*r, "t", None, 1, "w", 2, 3, "c", 4, 5, 6, 7, 8) for r in [*corpus(), (None, "x"), (None, None), *corpus()[:2]]]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").withColumn("quality_score", corpus_pipeline.F.lit("mine"))
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, FOLDER)
            assert out.columns == table.columns
            kept = Counter(r.doc_id for r in out.collect())
            assert kept <= Counter(r.doc_id for r in table.collect())
            assert {r.quality_score for r in out.collect()} <= {"mine"}
        assert corpus_pipeline.STAGES[-1][1](spark, table, FOLDER).count() >= table.count()
