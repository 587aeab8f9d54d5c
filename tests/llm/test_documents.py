"""Similarity joins, fingerprints, line runs, decontamination and the pipeline."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplecraft.llm import decontaminate, fingerprints, line_dedup, ngram_join, similar, words

from .conftest import CLASHING, awkward, corpus, empty, sentence


def shingles(text):
    w = [x for x in re.split(r"[\t-\r ]+", text or "") if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_classes(rows, threshold=0.8):
    """Each row's smallest key of its class and number of links, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and common >= threshold * (len(sets[i]) + len(sets[j]) - common) - 1e-9:
            links[i] += 1
            links[j] += 1
            root[find(i)] = find(j)
    classes = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        classes[find(i)].append(key)
    low = {c: min((k for k in keys if k is not None), default=None) for c, keys in classes.items()}
    return Counter((key, low[find(i)], links[i]) for i, (key, _) in enumerate(rows))


@pytest.mark.parametrize("operator", [ngram_join.similar_documents, fingerprints.near_duplicates])
def test_similar_documents(spark, operator):
    docs = awkward(spark, corpus())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in operator(docs).collect())
    assert got == brute_classes(rows)
    assert operator(empty(spark)).count() == 0


def test_many_near_copies_in_several_cells(spark, monkeypatch):
    monkeypatch.setattr(similar, "CELL", 8)
    rng = random.Random(1)
    base, rows = sentence(rng, 120), []
    for i in range(70):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.similar_documents(docs).collect())
    assert got == brute_classes(rows)


def test_posterior():
    """The least agreements against a numerical integral of the Beta density."""
    t, tolerance = 0.8, 1e-6
    x = np.linspace(0, 1, 200001)
    for turn, least in enumerate(ngram_join.least_agreements(t, tolerance)):
        n = 16 * (turn + 1)
        for m, kept in ((least, True), (least - 1, False)):
            if 0 <= m <= n:
                density = x**m * (1 - x) ** (n - m)
                assert (density[x >= t].sum() / density.sum() >= tolerance) == kept


def test_pruning_keeps_all_similar_pairs():
    rng = np.random.default_rng(0)
    least = ngram_join.least_agreements(0.8, 1e-9)
    base = rng.integers(0, 1 << 16, 128).astype(np.uint16)
    table = np.stack([np.where(rng.random(128) < s, base, rng.integers(0, 1 << 16, 128)).astype(np.uint16) for s in [1, 0.9, 0.8, 0.3, 0.1, 0]])
    i, j = ngram_join.surviving(table[:1], table, least)
    assert set(j.tolist()) == {0, 1, 2}


def test_overlap_counts_in_slabs(monkeypatch):
    monkeypatch.setattr(similar, "SLAB", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(9)]
    got = similar.overlaps(sets[:4], sets[4:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]).all()


def test_chains_are_one_class(spark):
    edges = [(i, i - 1 if i % 7 else i) for i in range(1, 200)] + [(500, 3), (501, 500)]
    got = {r["node"]: r["class"] for r in similar.components(spark.createDataFrame(edges, "node long, root long")).collect()}
    expected = {}
    for i in range(200):
        expected[i] = i // 7 * 7
    assert all(got[i] == expected[i] for i in got if i < 200) and got[500] == got[501] == 0
    assert similar.components(spark.createDataFrame([], "node long, root long")).count() == 0


def test_a_long_shuffled_chain_is_one_class(spark):
    names = random.Random(3).sample(range(10**6), 3000)
    edges = [(max(a, b), min(a, b)) for a, b in zip(names, names[1:])]
    got = similar.components(spark.createDataFrame(edges, "node long, root long")).collect()
    assert {r["node"]: r["class"] for r in got} == dict.fromkeys(names, min(names)) and len(got) == 3000


def test_one_of_each(spark):
    docs = awkward(spark, corpus())
    classes = ngram_join.similar_documents(docs).collect()
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in left.collect())
    assert max(kept.values()) == 1
    by_class = defaultdict(set)
    for r in classes:
        by_class[r.class_id].add(r.doc_id)
    for low, keys in by_class.items():
        if low is not None:
            assert {k for k, _ in kept if k in keys} == {low}
    assert {None} == {t for k, t in kept if k is None} - {"a text without a key"}
    assert ngram_join.one_of_each(empty(spark)).count() == 0


def test_word_and_shingle_hashes():
    import pyarrow as pa

    texts = ["a b  c\td e\nf", "", None, "x", " a b c d e f ", "e f", "é ü", "é ü"]
    data, bounds = words.text_bytes(pa.array(texts).slice(0))
    hashes, at = words.word_hashes(data, bounds)
    assert np.diff(at).tolist() == [6, 0, 0, 1, 6, 2, 2, 2]
    assert (hashes[at[0] : at[1]] == hashes[at[4] : at[5]]).all() and len(set(hashes.tolist())) == 9
    found, ends = words.shingle_hashes(hashes, at)
    assert np.diff(ends).tolist() == [2, 0, 0, 1, 2, 1, 1, 1]


def test_edited_fingerprints(spark):
    docs = awkward(spark, corpus() + [(2000, "日本語 " * 50), (2001, "ü")])
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-(r[0] if r[0] is not None else -(10**9)), r[1]))
    expected = Counter()
    for (key, text), (_, follow) in zip(rows, [*rows[1:], rows[0]]):
        edited = text[: len(text) - len(text) // 2] + follow[: len(text) // 2]
        expected[key, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = fingerprints.edited_fingerprints(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    by_text = {(r.doc_id, r.n_chars): r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert all(by_text[r.doc_id, r.n_chars] == r.fingerprint for r in got)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    checked = spark.createDataFrame(got).select("near_edited", fingerprints.likeness("fingerprint", "edited_fingerprint").alias("x")).collect()
    assert all(r.near_edited == r.x for r in checked)
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0


def test_an_only_document_is_its_own_next(spark):
    row = fingerprints.edited_fingerprints(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).first()
    # "a b c d" keeps "a b " and gets the first three of itself.
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()


def test_likeness_estimates_similarity(spark):
    rng = random.Random(4)
    base, rows, truth = sentence(rng, 400), [], []
    for i in range(30):
        copy = list(base)
        for _ in range(i * 3):
            copy[rng.randrange(400)] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
        a, b = shingles(rows[0][1]), shingles(rows[-1][1])
        truth.append(len(a & b) / len(a | b))
    prints = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    first = prints.filter("doc_id = 0").select(F.col("fingerprint").alias("f"))
    got = prints.crossJoin(first).select("doc_id", fingerprints.likeness("fingerprint", "f").alias("x")).collect()
    assert max(abs(r.x - truth[r.doc_id]) for r in got) < 0.2


def lines_corpus(seed=7):
    rng = random.Random(seed)
    long_runs = [[" ".join(sentence(rng, rng.randint(1, 20))) for _ in range(rng.randint(3, 12))] for _ in range(5)]
    common = "the same short line"
    texts = []
    for i in range(60):
        out = []
        for _ in range(rng.randint(0, 4)):
            run = rng.choice(long_runs)
            a = rng.randrange(len(run))
            out += rng.choice([run, run[a:], [common], [""], [" ".join(sentence(rng, 30))], run * 2])
        texts.append("\n".join(out))
    texts += [None, "", "\n\n", "x\n" * 200, texts[3], "one " * 60, "one " * 60 + "\n"]
    return [(i * 2, t) for i, t in enumerate(texts)]


def brute_lines(rows, least=50):
    """Text left of each distinct (key, text), by following every maximal run of lines
    that stands earlier too."""
    docs = sorted({(k, t or "", t) for k, t in rows if k is not None}, key=lambda d: d[0])
    lines = [(d, i, x) for d, (_, t, _) in enumerate(docs) for i, x in enumerate(t.split("\n"))]
    places, gone, out = defaultdict(list), defaultdict(set), {}
    for at, (_, _, x) in enumerate(lines):
        places[x].append(at)

    def equal(p, q, step):  # whether the lines next to these are equal, inside their documents
        if p + step < 0 or q + step >= len(lines):
            return False
        (d, i, _), (e, j, _) = lines[p], lines[q]
        return lines[p + step][:2] == (d, i + step) and lines[q + step][:2] == (e, j + step) and lines[p + step][2] == lines[q + step][2]

    for same in places.values():
        for n, q in enumerate(same):
            for p in same[:n]:
                if not equal(p, q, -1):
                    size = 1
                    while equal(p + size - 1, q + size - 1, 1):
                        size += 1
                    if sum(x.count(" ") + 1 for _, _, x in lines[q : q + size]) >= least:
                        gone[lines[q][0]].update(range(lines[q][1], lines[q][1] + size))
    for d, (k, t, original) in enumerate(docs):
        left = [x for i, x in enumerate(t.split("\n")) if i not in gone[d]]
        out[k] = ((None if gone[d] else original) if not left or not gone[d] else "\n".join(left), len(gone[d]))
    return out


@pytest.mark.parametrize("least", [50, 7, 1])
def test_line_dedup(spark, least):
    rows = lines_corpus()
    schema = f"doc_id long, text string, {CLASHING}"
    docs = spark.createDataFrame([(*r, "t", None, 1, "w", 2, 3, "c", 4, 5, 6, 7, 8) for r in rows + rows[:2]], schema).repartition(4)
    out = line_dedup.dedup_lines(docs, min_words=least, counts=True).drop("lines").collect()
    expected = brute_lines(rows, least)
    assert len(out) == len(rows) + 2
    for r in out:
        assert (r.text, r.n_deleted) == expected[r.doc_id], r.doc_id
    dropped = line_dedup.dedup_lines(docs, min_words=least, drop_emptied=True)
    assert dropped.columns == docs.columns
    assert {r.doc_id for r in dropped.collect()} == {k for k, (t, n) in expected.items() if t is not None or not n}


def lines_in_repeats(rows, least):
    """The lines of each document that stand in any run of ``least`` words or more, of
    any length, that starts earlier too."""
    docs = sorted((k, (t or "").split("\n")) for k, t in dict(rows).items())
    seen, gone = set(), {k: set() for k, _ in docs}
    for k, lines in docs:
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = tuple(lines[i : j + 1])
                if sum(x.count(" ") + 1 for x in run) >= least:
                    if run in seen:
                        gone[k].update(range(i, j + 1))
                    seen.add(run)
    return gone


def line_of(rng, n):
    return " ".join(sentence(rng, n))


@pytest.mark.parametrize("sizes", [(60, 10, 10), (30, 30, 10), (10, 30, 30), (10, 10, 60), (20, 20, 20, 20), (49, 1, 1), (1,) * 55, (25, 49, 1, 49, 25)])
def test_maximal_runs_go_as_a_whole(spark, sizes):
    rng = random.Random(5)
    run = [line_of(rng, n) for n in sizes]
    texts = [[line_of(rng, 70), *run], [line_of(rng, 3), *run, "own", *run[1:]], run]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).collect()
    expected = lines_in_repeats(rows, 50)
    for r in out:
        assert r.n_deleted == len(expected[r.doc_id])
        left = [x for i, x in enumerate(texts[r.doc_id]) if i not in expected[r.doc_id]]
        assert r.text == ("\n".join(left) if left else None)
    assert {r.doc_id: r.n_deleted for r in out}[2] == len(sizes)


@pytest.mark.parametrize("least", [50, 7])
def test_repeats_of_any_length(spark, least):
    rows = [(k, t) for k, t in lines_corpus(8) if (t or "").count("\n") < 60]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=least, counts=True).collect()
    expected = lines_in_repeats(rows, least)
    for r in out:
        left = [x for i, x in enumerate((dict(rows)[r.doc_id] or "").split("\n")) if i not in expected[r.doc_id]]
        assert r.n_deleted == len(expected[r.doc_id]) and (r.text or "") == "\n".join(left), r.doc_id


def test_line_dedup_of_odd_tables(spark):
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    text = "w " * 60
    docs = spark.createDataFrame([(1, "a"), (None, text), (None, None), (2, text), (2, text), (2, text + "z")], "doc_id long, text string")
    out = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert out == Counter({(1, "a"): 1, (None, text): 1, (None, None): 1, (2, None): 2, (2, text + "z"): 1})


def split_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute_overlaps(rows, items):
    out = {}
    for key, text in rows:
        doc = split_words(text)
        for item, item_text in items:
            own = split_words(item_text)
            if len(own) < 4:
                if own and any(split_words(line) == own for line in (text or "").split("\n")):
                    out[key, item] = max(len(own), out.get((key, item), 0))
                continue
            best, need = 0, len(own) if len(own) < 7 else len(own) - 1 if len(own) < 13 else 11
            for shift in range(-len(own), len(doc) + 1):
                equal = [0 <= p + shift < len(doc) and doc[p + shift] == w for p, w in enumerate(own)]
                best = max([best] + [sum(equal[p : p + 13]) for p in range(len(own))])
            if best >= need:
                out[key, item] = max(best, out.get((key, item), 0))
    return out


@pytest.mark.parametrize("n", range(1, 13))
def test_short_items(spark, n):
    """One substitution from 7 words on; up to 3 words, a line of its own."""
    rng = random.Random(n)
    own, text = [f"item{i}" for i in range(n)], sentence(rng, 30)
    rows = [(0, " ".join(text)), (1, " ".join(text[:9] + own + text[9:])), (2, "\n".join(["a", " ".join(own) + "!", "b"]))]
    rows += [(3 + i, " ".join(text[:4] + own[:i] + ["x"] + own[i + 1 :] + text[4:])) for i in range(n)]
    found = decontaminate.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(own))], "item_id long, text string"))
    got = {(r._doc, r.item): r.equal for r in found.collect()}
    assert got == brute_overlaps(rows, [(7, " ".join(own))])
    assert {k for k, _ in got} == {2} | ({1} if n > 3 else set()) | (set(range(3, 3 + n)) if n >= 7 else set())


def test_any_two_substitutions_leave_a_seed():
    for lost in itertools.chain([()], *(itertools.combinations(range(13), n) for n in (1, 2))):
        assert any(
            all(bit == "0" or start + k not in lost for k, bit in enumerate(mask))
            for mask in decontaminate.MASKS
            for start in range(13 - len(mask) + 1)
        )


def contaminated():
    rng = random.Random(11)
    items = [(i, " ".join(sentence(rng, n))) for i, n in enumerate([13, 14, 20, 40, 60, 12, 5, 4, 3, 1, 0, 6, 7, 8, 9, 10, 11])]
    items += [(3, items[2][1]), (None, " ".join(sentence(rng, 15))), (77, None), items[0]]
    docs = []
    for i in range(80):
        text = sentence(rng, rng.randint(0, 60))
        _, inside = rng.choice(items)
        inside = (inside or "").split()
        for _ in range(rng.randrange(4)):
            if inside:
                inside[rng.randrange(len(inside))] = "sub"
        a = rng.randrange(3)
        at = rng.randint(0, len(text))
        gap = rng.choice([" ", " ", "\n"])
        docs.append((i, gap.join(" ".join(p) for p in (text[:at], [w.upper() + "," for w in inside[a:]], text[at:]))))
    return docs + [(200, None), (201, ""), (202, "a"), (203, " ".join(sentence(rng, 20000)) + " " + items[3][1])], items


@pytest.mark.parametrize("seeds", [50_000, 40])
def test_decontamination(spark, monkeypatch, seeds):
    monkeypatch.setattr(decontaminate, "SEEDS", seeds)
    rows, items = contaminated()
    docs = awkward(spark, rows)
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, seed int")
    found = decontaminate.overlaps(docs, benchmark)
    everything = [(r.doc_id, r.text) for r in docs.collect()]
    got = {(r._doc, r.item): r.equal for r in found.collect()}
    assert got == brute_overlaps(everything, items)
    clean = decontaminate.decontaminate(docs, benchmark)
    bad = {k for k, _ in got}
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(k for k, _ in everything if k not in bad)
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).count() == len(everything)
    assert decontaminate.decontaminate(empty(spark), benchmark).count() == 0
