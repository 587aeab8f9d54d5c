"""Merkle manifest, mixing and tokenizer alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from samplecraft.llm import alignment, merkle, mixing, queries
from samplecraft.llm.tokens import tokenizer_file

from .conftest import CLASHING, corpus

FOLDER = "/root/testdata/sf0.001"
SCHEMA = f"doc_id long, source string, text string, {CLASHING}"
EXTRA = ("t", None, 1, "w", 2, 3, "c", 4, 5, 6, 7, 8)
CLASHES = "key_ string, leaf string, other string, tree long, node string, path string, size long, draw string, before long, part int"


def sourced(spark, n=200, seed=3, extra=True):
    """Documents of a hot source, small ones, sources without words and a null one."""
    rng = random.Random(seed)
    texts = [t for _, t in corpus(seed)]
    rows = []
    for i in range(n):
        source = rng.choice(["hot", "hot", "hot", "a", "b", "é", "", None, "Z"])
        rows.append((i, source, rng.choice(texts)))
    rows += [(7, "one", "just this"), (8, "void", ""), (9, "void", None), (None, "hot", "no key"), (None, None, None)]
    rows += rows[:3] + [rows[0][:2] + ("another text",)]
    if not extra:
        return rows, spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    wide = [(*r, *EXTRA, "k", "l", "o", 5, "n", "p", 6, "d", 7, 8) for r in rows]
    return rows, spark.createDataFrame(wide, f"{SCHEMA}, {CLASHES}").repartition(5)


# -- manifest ------------------------------------------------------------------------


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The top, and for each node its siblings left and right, level by level."""
    paths, owner = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            i = owner[k]
            path.append(("".join(nodes[i - i % 3 : i]), "".join(nodes[i + 1 : i - i % 3 + 3])))
            owner[k] = i // 3
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_manifest(rows):
    """Counted (key, leaf, subroot, siblings) and the root; rows are (key, source, leaf)."""
    sources = defaultdict(list)
    for key, source, leaf in rows:
        sources[source].append((key is not None, key or 0, leaf, key))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda r: r[:3])
        trees[s] = brute_tree([r[2] for r in sources[s]])
    root, tops = brute_tree([trees[s][0] for s in order])
    found = Counter()
    for s, top in zip(order, tops):
        subroot, paths = trees[s]
        for (_, _, leaf, key), path in zip(sources[s], paths):
            found[key, leaf, subroot, tuple(path + top)] += 1
    return root, found


@pytest.mark.parametrize("n", [0, 1, 26, 27, 28, 200])
def test_manifest(spark, n):
    rows, df = sourced(spark, n) if n else ([(1, "a", "x")], spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string"))
    manifest = merkle.build(df, ["doc_id", "source", "text"])
    root, found = brute_manifest([(k, s, brute_leaf((k, s, t))) for k, s, t in rows])
    assert manifest.root() == root
    ours = Counter((r.key, r.leaf, r.subroot, tuple((p.left, p.right) for p in r.path)) for r in manifest.proofs().collect())
    assert ours == found
    subroots = {(r.source, r.subroot): r.leaves for r in manifest.subroots().collect()}
    assert sum(subroots.values()) == len(rows) and {s for s, _ in subroots} == {s for _, s, _ in rows}


def test_many_leaves_of_one_source(spark):
    """More levels than a persisted step has, and numbers just above and below a power."""
    for n in (82, 729, 2188):
        df = spark.range(n).selectExpr("id AS doc_id", "'s' AS source", "cast(id % 10 AS string) AS text")
        manifest = merkle.build(df, ["doc_id", "text"])
        root, found = brute_manifest([(i, "s", brute_leaf((i, i % 10))) for i in range(n)])
        assert manifest.root() == root
        assert Counter((r.key, r.leaf, r.subroot, tuple((p.left, p.right) for p in r.path)) for r in manifest.proofs().collect()) == found


def test_manifest_of_nothing(spark):
    manifest = merkle.build(spark.createDataFrame([], SCHEMA), ["doc_id", "source", "text"])
    assert manifest.root() is None and manifest.proofs().isEmpty() and manifest.subroots().isEmpty()


def test_manifest_levels_are_kept(spark):
    """Only every third level is stored, and order and partitions do not matter."""
    rows, df = sourced(spark)
    manifest = merkle.build(df, ["doc_id", "source", "text"])
    stored = [level.count() for level in manifest.sources.levels]
    assert stored[0] == len(rows) and stored[1] < len(rows) / 10 and len(stored) == 3
    assert merkle.build(df.repartition(2).orderBy("text"), ["doc_id", "source", "text"]).root() == manifest.root()


def test_tampered_documents_are_found(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_merkle"](spark, FOLDER).collect()}
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    assert set(rows) == set(docs.doc_id)
    for r in docs.itertuples():
        hit = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in r.text
        assert rows[r.doc_id].verified == (not hit)
        assert (rows[r.doc_id].folded_root == rows[r.doc_id].root) == (not hit)


# -- mixing --------------------------------------------------------------------------


def brute_targets(sizes: dict, weights=(5, 2, 1), share=Fraction(3, 2), most=2) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {s: Fraction(0) for s in sizes}, set(sizes)
    while open_ and left:
        total, rest = sum(weight[s] for s in open_), Fraction(0)
        for s in open_:
            target[s] += left * weight[s] / total
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = Fraction(most * sizes[s])
                open_.remove(s)
        left = rest
    return target


def words(text) -> int:
    return len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else "x" for c in text or "").split(" ") if w])


@pytest.mark.parametrize("weights,share,most", [((5, 2, 1), Fraction(3, 2), 2), ((1,), Fraction(1, 3), 1), ((1, 9), Fraction(7, 2), 4)])
def test_mixing(spark, weights, share, most):
    rows, df = sourced(spark)
    plan = mixing.plan_mix(df, weights=weights, share=share, most=most)
    found = plan.collect()
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += words(t)
    assert Counter((r.doc_id, r.source, r["size"]) for r in found) == Counter((k, s, words(t)) for k, s, t in rows)
    target, taken, cut = brute_targets(sizes, weights, share, most), defaultdict(int), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(target[r.source]), abs=1e-6)
        assert 0 <= r.taken <= most * r["size"]
        taken[r.source] += r.taken
        whole = int(target[r.source]) // sizes[r.source] if sizes[r.source] else 0
        cut[r.source] += whole * r["size"] < r.taken < (whole + 1) * r["size"]
    assert max(cut.values()) <= 1  # of each source at most one document is cut
    for s in sizes:
        assert abs(taken[s] - float(target[s])) <= 1
    drawn = mixing.draws(plan).collect()
    assert sum(r.words for r in drawn) == sum(taken.values()) and all(0 < r.words <= r["size"] for r in drawn)
    again = mixing.plan_mix(df.repartition(2), weights=weights, share=share, most=most).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    if share < most:
        other = mixing.plan_mix(df, weights=weights, share=share, most=most, seed=9).collect()
        assert Counter((r.source, r.taken) for r in other) != Counter((r.source, r.taken) for r in found)


def test_mixing_by_a_given_size(spark):
    df = spark.createDataFrame([(1, "a", None, 3), (2, "a", "x y", None), (3, "b", "x", 5)], "doc_id long, source string, text string, n int")
    from pyspark.sql import functions as F

    found = {r.doc_id: r for r in mixing.plan_mix(df, size=F.col("n")).collect()}
    assert [found[k]["size"] for k in (1, 2, 3)] == [3, 0, 5] and sum(r.taken for r in found.values()) == 12
    with pytest.raises(ValueError):
        mixing.plan_mix(df, share=Fraction(3), most=2)


def test_mixing_of_nothing(spark):
    assert mixing.plan_mix(spark.createDataFrame([], SCHEMA)).isEmpty()
    empty = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [(r["size"], r.target, r.taken) for r in mixing.plan_mix(empty).collect()] == [(0, 0.0, 0)] * 2


def test_targets_take_many_rounds(spark):
    """Sources that fill one after the other, each round lifting the next above its most."""
    sizes = {f"s{i:02}": 2**i for i in range(20)}
    sources = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, weight int")
    found = {r.source: r.target for r in mixing.targets(sources).collect()}
    assert found == pytest.approx({s: float(t) for s, t in brute_targets(sizes, (1,)).items()})


# -- alignment -----------------------------------------------------------------------


def brute_alignment(docs):
    """Per document its figures, counted; by plain loops over tokens."""
    library = Tokenizer.from_file(tokenizer_file(alignment.TOKENIZER_A))
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(alignment.TOKENIZER_B))
    shown = alignment._byte_values()
    held, plain = Counter(), []
    for key, text in docs:
        sides = [[], []]
        if text:
            found = library.encode(" " + text, add_special_tokens=False)
            left = [(i, bytes(shown[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
            right = []
            for i in pieces.encode(text):
                piece = pieces.id_to_piece(i)
                right.append((i, bytes.fromhex(piece[3:5]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
            if b"".join(t for _, t in left) == (" " + text).encode() == b"".join(t for _, t in right):
                for side, tokens in zip(sides, (left, right)):
                    at = 0
                    for i, t in tokens:
                        side.append((at, at + len(t), i))
                        at += len(t)
        cuts = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
        groups = [[[i for _, e, i in side if low < e <= high] for side in sides] for low, high in zip([0, *cuts], cuts)]
        links = [(x, y) for left, right in groups for x in left for y in right]
        overlaps = sum(s < f and e < t for s, t, _ in sides[0] for e, f, _ in sides[1]) if len(sides[0]) < 3000 else None
        held.update(set(links))
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        plain.append((key, len(sides[0]), len(sides[1]), len(groups), overlaps, links, hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return held, Counter((*p[:4], p[4], len(p[5]), sum(held[x] == best[x[0]] for x in p[5]), sum(held[x] for x in p[5]), p[6]) for p in plain)


def awkward_texts():
    return [
        "", None, " ", "  two  spaces ", "\n\nlines\n", "tab\there", "▁already", "<s> </s> <|endoftext|> <0x41>", "é ü ñ 日本語 emoji 👩‍👩‍👧 ok", "a" * 5000,
        "=" * 300, "é decomposed", "zero​width space", "\x00 nul", "1234567890 3.14", "x", "The cat. The cat.", "The cat. The cat.", "日" * 700, "ab" * 3000 + " 日本" * 50, "x=" * 900, "\u2028\u00a0\u3000 odd\u0085 white\u200a space", "١٢٣ ½ ²³ Ⅷ 𝟘𝟙", "don't WE'LL i'Ve",
    ]


@pytest.mark.parametrize("slice_bytes,pairs", [(alignment.SLICE, alignment.PAIRS), (300, 50)])
def test_alignment(spark, monkeypatch, slice_bytes, pairs):
    monkeypatch.setattr(alignment, "SLICE", slice_bytes)
    monkeypatch.setattr(alignment, "PAIRS", pairs)
    docs = list(enumerate(awkward_texts())) + [(None, "no key at all"), (3, "  two  spaces ")]
    df = spark.createDataFrame([(*d, *EXTRA) for d in docs], f"doc_id long, text string, {CLASHING}").repartition(2)
    rows, pairs_found = alignment.align(df)
    held, expected = brute_alignment(docs)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups_sha256"]
    ours = Counter(tuple(r[c] for c in names) for r in rows.collect())
    for row, n in expected.items():  # overlaps are counted for all but the longest
        match = [r for r in ours if r[:4] == row[:4] and r[5:] == row[5:] and (row[4] is None or r[4] == row[4])]
        assert len(match) == 1 and ours[match[0]] == n
    assert sum(ours.values()) == len(docs)
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    assert {(r.a, r.b): (r.n, r.best) for r in pairs_found.collect()} == {p: (n, n == best[p[0]]) for p, n in held.items()}


def test_alignment_query(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    _, expected = brute_alignment(list(zip(docs.doc_id, docs.text)))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    ours = Counter(tuple(r[c] for c in names) for r in queries.QUERIES["op12_alignment"](spark, FOLDER).collect())
    assert ours == Counter({(*r[:4], *r[5:]): n for r, n in expected.items()})


def test_alignment_of_nothing(spark):
    rows, pairs = alignment.align(spark.createDataFrame([], f"doc_id long, text string, {CLASHING}"))
    assert rows.isEmpty() and pairs.isEmpty()


def test_row_products():
    """Gustavson's products against dense ones, however few products a step may have."""
    rng = np.random.default_rng(0)
    for _ in range(20):
        m, n, k = rng.integers(0, 12, 3)
        dense = [rng.integers(0, 3, s) * (rng.random(s) < 0.4) for s in ((m, n), (n, k))]
        a, b = (alignment.summed(*np.nonzero(d), d[np.nonzero(d)], d.shape) for d in dense)
        for most in (1, 7, 10**6):
            c = alignment.product(a, b, most)
            got = np.zeros((m, k), np.int64)
            got[c.rows(), c.col] = c.val
            assert (got == dense[0] @ dense[1]).all() and (c.val > 0).all()
        t = a.transposed()
        assert t.height == n and sorted(zip(t.col, t.rows(), t.val)) == sorted(zip(a.rows(), a.col, a.val))
