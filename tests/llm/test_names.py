"""Columns that are called like those that operators add inside."""

from samplecraft.llm import decontaminate, line_dedup, ngram_join, quality
from samplecraft.llm.names import fresh

NAMES = ["_runs", "_split", "_gone", "_again", "_BAD", "_bad_", "_doc", "_text", "_key"]


def test_fresh():
    assert fresh(["a", "_x", "_X_"], "_x") == "_x__" and fresh([], "_x") == "_x"


def test_inside_names_in_the_input(spark):
    item = " ".join(f"word{i}" for i in range(20))
    long = "\n".join(" ".join(f"l{i}w{j}" for j in range(12)) for i in range(6))
    texts = [item + " and more", long, long, "something else", "something else", None]
    rows = [(i - (i == 4), t, *[f"{n}{i}" for n in NAMES], (i, "x")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES) + ", odd struct<`a b`:long,`c,d`:string>")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")

    clean = decontaminate.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 3, 5]
    single = ngram_join.one_of_each(docs)
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == [0, 1, 3, 5]
    deduped = line_dedup.dedup_lines(docs)
    left = {r.doc_id: r for r in deduped.collect()}
    assert deduped.columns == docs.columns and left[1].text == long and left[2].text is None and left[2]._runs == "_runs2"

    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id long, quality int, toxic int")
    plain = docs.select("doc_id", "text", "odd")
    model = quality.train(plain, labels, ("quality", "toxic"), metadata=())
    scored = quality.score(plain, model)
    assert scored.columns[:3] == plain.columns and sorted(r.odd["a b"] for r in scored.collect()) == list(range(6))
