"""Packing, token files and token counts against the tokenizers library itself."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from samplecraft.llm import packing, token_counts, token_files, tokens, words
from samplecraft.llm.packing import Pool, binary_tail

from .conftest import awkward, corpus, empty

ODD = ["", None, "  ", "it's  <|endoftext|> x<|startoftext|>y z\x1cq é À İİ 'S don't ÉTÉ. a-b A--", "the\t\x0bthe", "a" * 300 + " b"]


@pytest.fixture(scope="module")
def library():
    return tokens.Encoder(tokens.WORD_TOKENIZER).tokenizer


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_are_those_of_whole_texts(library):
    encoder = tokens.Encoder(tokens.WORD_TOKENIZER)
    texts = ODD + [t for _, t in corpus()]
    for _ in range(2):  # a second call is like the first
        ids, at = encoder.ids(pa.array(texts))
        for k, text in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


SPACED = [
    "a  b\n\nc", None, "", " ", " lead and trail ", "x\ny", "x \ny", "x\n y", "tab\tx  y", "nb\u00a0 x", "nb \u00a0x y\u00a0\nz", "<|endoftext|> it's we'll",
    "naïve façade 漢字 \n 漢 字", "emoji 🙂🙂 x", "\u2028 a\u2028 b", "a\r\nb c", "1 22 333 ,,, ...\n...",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", tokens.WORD_TOKENIZER])
def test_spans_are_those_of_whole_texts(name):
    rng = random.Random(8)
    texts = SPACED + ODD + [t for _, t in corpus()]
    texts += ["".join(rng.choices(list("ab Zé\n \t'.1\u00a0漢"), k=rng.randint(1, 60))) for _ in range(400)]
    encoder = tokens.Encoder(name)
    assert (encoder.sizes is not None) == name.startswith("byte")
    for _ in range(2):
        first, after, at, begins = encoder.spans(pa.array(texts))
        ids, _ = encoder.ids(pa.array(texts))
        for k, text in enumerate(texts):
            one = encoder.tokenizer.encode(text or "", add_special_tokens=False)
            part = slice(at[k], at[k + 1])
            assert ids[part].tolist() == one.ids
            assert list(zip((first[part] - begins[k]).tolist(), (after[part] - begins[k]).tolist())) == one.offsets
            assert begins[k + 1] - begins[k] == len(text or "")


def test_plain_texts_have_the_ids_of_the_files_own_rules():
    from tokenizers import Tokenizer

    own, encoder = Tokenizer.from_file(tokens.tokenizer_file(tokens.WORD_TOKENIZER)), tokens.Encoder(tokens.WORD_TOKENIZER)
    rng = random.Random(9)
    ascii_ = [chr(c) for c in range(128)]
    parts = ["'s", "'LL", "It's", "don't", "<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "\r\n", "\t", "...", "42", "Tokens", "ORDER", "</w>", "\u0120"]
    texts = ascii_ + [a + b + c for a in "aZ 7.'" for b in ascii_ for c in "bY\n3-t"]
    texts += ["".join(rng.choices(ascii_[32:127] + parts, k=rng.randint(1, 80))) for _ in range(2000)]
    texts += ["".join(rng.choices(ascii_ + parts + list("é\u0301\u0338ſİΣ漢\u00a0\x85"), k=rng.randint(1, 40))) for _ in range(2000)]
    texts += SPACED + ODD + [t for _, t in corpus()]
    ids, at = encoder.ids(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == own.encode(text or "", add_special_tokens=False).ids, text


def test_only_plain_texts_go_to_the_shorter_rules():
    class Watched:
        def __init__(self, tokenizer):
            self.tokenizer, self.got = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.got += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder = tokens.Encoder(tokens.WORD_TOKENIZER)
    encoder.plain, encoder.tokenizer = Watched(encoder.plain), Watched(encoder.tokenizer)
    plain, other = ["a B\r\n\tc ~", "", "x <|endoftext|>"], ["é", "a\x0bb", "a\x7f", "a\x1cb", "a\u00a0b", "a\u2028b"]
    encoder.ids(pa.array([plain[0], *other[:3], None, plain[2], *other[3:]]))
    assert encoder.plain.got == plain and encoder.tokenizer.got == other


@pytest.mark.parametrize("change", ["normalizer", "pre_tokenizer", "split", "added"])
def test_files_with_other_rules_have_no_shorter_ones(tmp_path, change):
    import json

    with open(tokens.tokenizer_file(tokens.WORD_TOKENIZER), encoding="utf-8") as f:
        rules = json.load(f)
    if change == "normalizer":
        rules["normalizer"]["normalizers"].append({"type": "StripAccents"})
    elif change == "pre_tokenizer":
        rules["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"] = True
    elif change == "split":
        rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] += r"|\s+"
    else:
        rules["added_tokens"][0]["normalized"] = True
    path = str(tmp_path / "own.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rules, f)
    encoder, texts = tokens.Encoder(path), ["a  b's\n c", "<|startoftext|> É x"]
    assert encoder.plain is None and tokens.Encoder("byte_bpe_50k.json").plain is None
    ids, at = encoder.ids(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_tokenizer_of_another_kind_encodes_whole_texts(tmp_path):
    import json

    with open(tokens.tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        rules = json.load(f)
    rules["pre_tokenizer"]["add_prefix_space"] = True
    path = str(tmp_path / "own.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rules, f)
    encoder = tokens.Encoder(path)
    assert encoder.sizes is None
    first, after, at, begins = encoder.spans(pa.array(["a b\nc", None, "é x"]))
    one = encoder.tokenizer.encode("é x", add_special_tokens=False)
    assert list(zip((first[at[2] :] - begins[2]).tolist(), (after[at[2] :] - begins[2]).tolist())) == one.offsets


def test_packed_documents(spark, library):
    docs = awkward(spark, corpus() + [(10_000 + i, t) for i, t in enumerate(ODD)])
    rows = packing.pack_documents(docs, limits=(64, 5, 64), with_ids=True).collect()
    whole = Counter((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [1])) for r in docs.collect())
    sequences = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == crc(r.ids) and len(r.ids) == r.length > 0
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        size = sum(p.length for p in pieces)
        assert len(pieces) <= 5 and (size <= 64)
    found = Counter()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
    for (key, n), pieces in by_doc.items():
        for (k, ids), times in whole.items():
            if k == key and len(ids) == n:
                for p in pieces:
                    if list(ids[p.start : p.start + p.length]) == list(p.ids):
                        found[k, ids] += p.length
                assert found[k, ids] >= times * n
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in whole.items())
    assert packing.pack_documents(empty(spark)).count() == 0


def test_little_padding(spark):
    rows = packing.pack_documents(spark.createDataFrame(corpus(groups=12), "doc_id long, text string").coalesce(1)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.values()) == 0


def test_binary_tail():
    pieces = [(1, 0, 7, 3, 0), (2, 4, 6, 3, 7)]
    out = binary_tail(pieces, 3)
    assert sum(p[2] for p in out) == 13
    assert [(s, sum(p[2] for p in out if p[3] == s)) for s in (3, 4, 5)] == [(3, 8), (4, 4), (5, 1)]
    assert binary_tail([], 0) == []


def test_dot_product_prefers_what_is_plentiful():
    pool = Pool((100, 2, 100), cut=False)
    pool.add(np.array([1, 2, 3]), np.array([[10, 1, 90], [90, 1, 5], [50, 1, 50]], float))
    assert [(p[0], p[3], p[4]) for p in pool.pieces(0)] == [(1, 0, 0), (2, 0, 10), (3, 1, 0)]


def test_whole_examples_keep_all_limits(spark):
    rows = [(i, (i * 37) % 200 + 1, (i * 11) % 60) for i in range(300)] + [(None, 5, None), (7, None, -3), (8, 5000, 1), (0, 1, 0)]
    got = packing.pack_examples(spark.createDataFrame(rows, "example_id int, tokens int, loss_tokens int"), limits=(256, 4, 80)).collect()
    assert Counter(r.example_id for r in got) == Counter(r[0] for r in rows)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append(r)
    for parts in held.values():
        parts.sort(key=lambda r: (r.offset, r.tokens))
        fits = sum(p.tokens for p in parts) <= 256 and len(parts) <= 4 and sum(p.loss_tokens for p in parts) <= 80
        assert fits or len(parts) == 1
    bound = max(sum(min(t or 0, 256) for _, t, _ in rows) / 256, len(rows) / 4, sum(max(x or 0, 0) for *_, x in rows) / 80)
    assert len(held) <= 1.35 * bound + 9


def test_coding():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 1 << 32, n).astype(np.uint32) >> rng.integers(0, 32, n).astype(np.uint32)
        control, data = token_files.coded(values)
        assert len(control) == -(-n // 4)
        assert (token_files.decoded(control, data, n) == values).all()


def test_token_files(spark, library):
    docs = awkward(spark, corpus() + [(10_000 + i, t) for i, t in enumerate(ODD)])
    path = token_files.new_token_files(docs)
    rows = token_files.read_token_files(spark, path, with_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    expected = Counter((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == expected
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), crc(r.ids))
        start += r.n_tokens
    counts = Counter(x for (_, ids), n in expected.items() for x in ids for _ in range(n))
    ranks = list(spark.read.parquet(f"{path}/ranks").first().ids)
    assert ranks == sorted(counts, key=lambda x: (-counts[x], x))


def test_token_files_of_nothing(spark):
    assert token_files.read_token_files(spark, token_files.new_token_files(empty(spark))).count() == 0


def slow_counts(text, spans, rule):
    tokenizer = tokens.Encoder(token_counts.TOKENIZER).tokenizer
    offsets = tokenizer.encode(text, add_special_tokens=False).offsets
    out = []
    for a, b in spans:
        n, crossing = 0.0, 0
        for s, e in offsets:
            inside = max(0, min(e, b) - max(s, a))
            mine = {"first": a <= s < b, "last": a <= e - 1 < b, "split": inside > 0}[rule]
            n += inside / (e - s) if rule == "split" else mine
            crossing += bool(mine and inside < e - s)
        out.append((round(n, 9), crossing))
    return out, len(offsets)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections(spark, rule):
    text = "Hello   there\n\n  general kenobi, naïve façade 漢字 end\n" * 3
    spans = [(0, 3), (3, 14), (2, 60), (14, 14), (20, 500), (0, len(text))]
    rows = [(1, text, [("s", a, b) for a, b in spans]), (2, None, [("x", 0, 9)]), (3, "abc", None), (None, "", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<section:string,start:long,end:long>>")
    got = token_counts.count_tokens(docs, sections="spans", rule=rule).collect()
    expected, total = slow_counts(text, [(a, min(b, len(text))) for a, b in spans], rule)
    assert [(round(r.n_tokens, 9), r.crossing) for r in got if r.doc_id == 1] == expected
    assert {r.doc_tokens for r in got if r.doc_id == 1} == {total}
    assert [(r.n_tokens, r.start, r.end) for r in got if r.doc_id == 2] == [(0.0, 0, 0)]
    assert {r.doc_id for r in got} == {1, 2}


def test_lines_add_up_to_the_document(spark):
    docs = awkward(spark, corpus() + [(-5, "a\n\nb \n c")])
    rows = token_counts.count_tokens(docs).collect()
    per = defaultdict(list)
    for r in rows:
        per[r.doc_id, r.doc_tokens].append(r)
    for (key, total), parts in per.items():
        copies = sum(p.section == "0" for p in parts)
        assert sum(p.n_tokens for p in parts) == total * copies, key
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs, rule="middle")
    assert token_counts.count_tokens(empty(spark)).count() == 0


def test_fields(spark):
    docs = spark.createDataFrame([(1, "Title", None, "body text")], "doc_id long, a string, b string, c string")
    text, sections = token_counts.fields_as_text(["a", "b", "c"])
    rows = docs.select("doc_id", text.alias("text"), sections.alias("s"))
    got = token_counts.count_tokens(rows, sections="s").orderBy("start", "end").collect()
    assert [(r.section, r.start, r.end) for r in got] == [("a", 0, 6), ("b", 6, 7), ("c", 7, 16)]
    assert sum(r.n_tokens for r in got) == got[0].doc_tokens


def regular_words(n=1024):
    """Words that every polynomial hash modulo 2^64 takes for one: letters by the parity of
    the place's bits, and the same with the letters changed."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return [one, one.translate(str.maketrans("ab", "ba"))]


@pytest.mark.parametrize("name", [tokens.WORD_TOKENIZER, "byte_bpe_50k.json"])
def test_ids_of_regular_words(name):
    texts = [*regular_words(), *regular_words(16), *(w * 2 for w in regular_words(8)), " ".join(regular_words())]
    encoder = tokens.Encoder(name)
    for _ in range(2):
        ids, at = encoder.ids(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_hashes_of_regular_words_and_slices():
    texts = [w for n in (8, 64, 1024, 4096) for w in regular_words(n)] + ["a" * n for n in range(1, 40)] + ["\x00" * n for n in range(1, 20)]
    data, bounds = words.text_bytes(pa.array(texts))
    for which in (0, 1):
        whole = words.span_hashes(data, bounds[:-1], bounds[1:], which)
        assert len(set(whole.tolist())) == len(texts)
        for k in range(len(texts)):  # a word's hash does not depend on what stands around it
            own = data[bounds[k] : bounds[k + 1]]
            assert words.span_hashes(own, np.array([0]), np.array([len(own)]), which)[0] == whole[k]
